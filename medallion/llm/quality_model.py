"""Quality by the perplexity of an interpolated modified Kneser-Ney n-gram model of words.

Words are lower-cased runs of letters and digits, other marks, and single characters of scripts
that put no blanks between words. Trigrams of all trusted documents but a held-out share are
counted by 64-bit word hashes, without a limit on the vocabulary; counts, discounts, context
weights and values are tables sharded by hash, whose size grows with the trusted text. A word
never seen is spelled by a model of characters (64 symbols, four-grams), times the share of each
character among those of its symbol.

The log probability of a word after two others is a sum of one value for each of the grams and
contexts that the model knows, see ``word_values``; so a document's is the sum of its grams'
values. The grams of each distinct text are combined in each task, joined with the values and
summed per text.

The grams of all texts are several times the input. So that they need not lie on disk at once,
each shard of a task's grams and of the values is one row of packed numbers, and the work goes in
rounds: trigrams by their middle word, which their contexts and lower orders share, and texts by
their hash. Each round's shuffles and scratch tables are deleted before the next.

A document passes if its cross-entropy is not above a limit that follows from the held-out
trusted documents of its language, and no gram of it speaks more for the documents labelled as
bad or toxic than those of the held-out trusted ones do, see ``evidence``: a single word hardly
changes the cross-entropy of a long text.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import arrow_table, bounded_batches, gathered, slices, written
from medallion.session import work_folder
from medallion.sources import files

ORDER = 4
BITS = 6
SYMBOLS = 1 << BITS
OWN_SYMBOLS = 52
# Symbols: blank, then characters of their own, then shared ones.
BLANK = 0
# Share of a language's held-out trusted documents that pass, and the characters of average text
# by which a document's cross-entropy is steadied, as a few letters tell little. Both were chosen
# on labelled rows of sf0.1 that the counts had not seen, see README.
QUANTILE = 0.97
STEADY = 20
# Share of all held-out trusted documents whose grams' evidence passes, and the standard errors
# by which a gram's log odds must stand out.
EVIDENCE_QUANTILE = 0.99
ERRORS = 1.64
# Steps of cross-entropy in which the quantile is found, in nats.
STEP = 1e-3
# No symbol is less probable: a few counts may leave nothing for what they lack.
LEAST = 1e-7
BATCH_BYTES = 1_500_000
# Text whose grams are combined before they are shuffled.
PIECE_BYTES = 4_000_000
# One in so many distinct trusted texts is held out of the counts and sets the limits.
HELD_OUT = 5
# Costs and values are summed as whole numbers of this part of a nat, in any order alike.
UNIT = 1 << 20
# Characters of scripts without blanks between words: Thai, Lao, Burmese, Khmer, kana, Han.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+|[^\w\s]")
# Stand before and after the words of a text; no word is like them.
START, END = "<start", "<end"
# Keys of the rows that carry what spelling a text costs, and how many words it has.
SPELLED, WORDS = 0, 1
# Shards of keys by their first bits, each a row of a task's piece and a group of the join.
SHARD_BITS = 8
SHARDS = 1 << SHARD_BITS
# Rounds at most, and the characters of all texts from which there is one more.
TEXT_ROUNDS, TEXT_CHARS = 8, 16_000_000
VALUE_ROUNDS, VALUE_CHARS = 10, 16_000_000
# Rounds in which the trigrams are counted, and the grams of labelled texts compared.
COUNT_ROUNDS, EVIDENCE_ROUNDS = 3, 2
# Parts of the packed values, which are merged one after the other.
MERGES = 4
# Spark's setting that deletes the shuffle files of a write when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Nats added to the limit over the root of the documents it was found in: few tell little.
ALLOWANCE = 0.8


def _lowered() -> np.ndarray:
    """Lower-case form of each code point below 0x3000 as one code point; others as they are."""
    table = np.arange(0x110000, dtype=np.int32)
    for point in range(0x3000):
        low = chr(point).lower()
        if len(low) == 1:
            table[point] = ord(low)
        if chr(point).isspace():
            table[point] = 32
        if chr(point).isdecimal():
            table[point] = 48
    return table


@lru_cache(maxsize=1)
def _codes(alphabet: str) -> np.ndarray:
    """The symbol of each code point."""
    lowered = _lowered()
    shared = SYMBOLS - 1 - len(alphabet)
    symbols = 1 + len(alphabet) + lowered % shared
    for i, char in enumerate(alphabet):
        symbols[lowered == ord(char)] = 1 + i
    symbols[lowered == 32] = BLANK
    return symbols.astype(np.uint8)


def grams(texts: Sequence[str], alphabet: str) -> tuple[np.ndarray, np.ndarray]:
    """The four-gram number of each character of the texts, and the texts' lengths. The first
    characters have blanks before them."""
    pad = ORDER - 1
    joined = (" " * pad).join(["", *texts])
    codes = _codes(alphabet)[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")]
    codes = codes.astype(np.int32)
    number = codes[pad:].copy()
    for back in range(1, ORDER):
        number |= codes[pad - back : len(codes) - back] << (BITS * back)
    lengths = np.array([len(t) for t in texts], np.int64)
    padded = np.arange(len(number)) - np.repeat(np.cumsum(lengths + pad) - lengths - pad, lengths + pad)[: len(number)]
    return number[padded < np.repeat(lengths, lengths + pad)[: len(number)]], lengths


def characters(docs: DataFrame) -> DataFrame:
    """(point, n): how often each character occurs in the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, lowered = np.zeros(0x110000, np.int64), _lowered()
        for batch in batches:
            for start, end in slices(batch.column("text"), BATCH_BYTES):
                text = "".join(batch.column("text").slice(start, end - start).to_pylist())
                points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
                counts = np.bincount(lowered[points])
                totals[: len(counts)] += counts
        used = np.flatnonzero(totals)
        yield arrow_table(pa.schema([("point", pa.int32()), ("n", pa.int64())]), used, totals[used])

    counts = docs.where("text is not null").select("text").mapInArrow(count, "point int, n bigint")
    return counts.groupBy("point").agg(F.sum("n").alias("n"))


def _alphabet(counts: DataFrame) -> str:
    top = counts.where("point <> 32").orderBy(F.desc("n"), "point").limit(OWN_SYMBOLS).collect()
    return "".join(sorted(chr(r["point"]) for r in top))


def frequent(docs: DataFrame) -> str:
    """The most frequent characters of the texts, blanks left out."""
    return _alphabet(characters(docs))


def shares_of_symbols(counts: DataFrame, alphabet: str) -> np.ndarray:
    """Minus the log of each code point's share among those of its symbol, one added to each."""
    rows = counts.toPandas()
    totals = np.ones(0x110000)
    totals[rows["point"].to_numpy()] += rows["n"].to_numpy()
    lowered, codes = _lowered(), _codes(alphabet)
    stands = lowered == np.arange(0x110000)
    symbols = np.bincount(codes[stands], totals[stands], SYMBOLS)
    return -np.log(totals[lowered] / symbols[codes]).astype(np.float32)


def gram_counts(trusted: DataFrame, alphabet: str) -> DataFrame:
    """(gram, n) over all trusted text, combined in each task before it is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(SYMBOLS**ORDER, np.int32)
        for batch in batches:
            for start, end in slices(batch.column("text"), BATCH_BYTES):
                number, _ = grams(batch.column("text").slice(start, end - start).to_pylist(), alphabet)
                some, counts = np.unique(number, return_counts=True)
                totals[some] += counts.astype(np.int32)
        used = np.flatnonzero(totals)
        yield arrow_table(pa.schema([("gram", pa.int64()), ("n", pa.int64())]), used, totals[used])

    rows = trusted.select("text").mapInArrow(count, "gram bigint, n bigint")
    return rows.groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The three discounts of an order from its counts of counts."""
    return _discounts(counts.agg(*_counts_of_counts()).first())


def _counts_of_counts() -> list[Column]:
    return [F.count_if(F.col("n") == k).alias(f"_n{k}") for k in (1, 2, 3, 4)]


def _discounts(row: Sequence[int | None]) -> tuple[float, float, float]:
    n1, n2, n3, n4 = (float(x or 0) for x in row)
    share = n1 / (n1 + 2 * n2) if n1 else 0.0
    found = []
    for k, (here, above) in enumerate(((n1, n2), (n2, n3), (n3, n4)), start=1):
        found.append(min(max(k - (k + 1) * share * above / here, 0.0), float(k)) if here else share)
    return tuple(found)


def probabilities(counts: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """For orders 1 to 4 the discounted shares (gram, share) and for each context the weight of
    the next lower order (context, weight).

    The highest order counts occurrences, the lower ones the different symbols before.
    """
    tables = [written(counts, "grams")]
    for order in range(ORDER - 1, 0, -1):
        lower = tables[0].groupBy((F.col("gram") % SYMBOLS**order).alias("gram"))
        tables.insert(0, written(lower.agg(F.count("*").alias("n")), "grams"))
    shares, weights = [], []
    for table in tables:
        one, two, three = discounts(table)
        taken = _by_count(F.lit(one), F.lit(two), F.lit(three))
        context = F.shiftright("gram", BITS).alias("context")
        sums = table.groupBy(context).agg(F.sum("n").alias("total"), F.sum(taken).alias("taken"))
        sums = written(sums, "contexts")
        joined = table.withColumn("context", F.shiftright("gram", BITS)).join(sums, "context")
        shares.append(joined.select("gram", ((F.col("n") - taken) / F.col("total")).alias("share")))
        weights.append(sums.select("context", (F.col("taken") / F.col("total")).alias("weight")))
    return shares, weights


def _by_count(one: Column, two: Column, three: Column) -> Column:
    return F.when(F.col("n") == 1, one).when(F.col("n") == 2, two).otherwise(three)


def costs(shares: list[DataFrame], weights: list[DataFrame]) -> np.ndarray:
    """Minus the log probability of each four-gram's last symbol after the others.

    Order by order: what a context leaves over is spread by the order below, evenly at the
    end; contexts that were never seen leave all of it.
    """
    lower = np.full(SYMBOLS, 1 / SYMBOLS, np.float32)
    for order, (share, weight) in enumerate(zip(shares, weights, strict=True), start=1):
        left = np.ones(SYMBOLS ** (order - 1), np.float32)
        table = weight.toPandas()
        left[table["context"].to_numpy()] = table["weight"].to_numpy()
        here = np.tile(lower.reshape(-1, SYMBOLS), (SYMBOLS if order > 1 else 1, 1))
        here *= left[:, None]
        table = share.toPandas()
        here.ravel()[table["gram"].to_numpy()] += table["share"].to_numpy().astype(np.float32)
        lower = here.ravel()
    np.maximum(lower, LEAST, out=lower)
    return -np.log(lower, out=lower).astype(np.float16)


def trusted_text(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents labelled as good and not as toxic. There may be as many as documents, so that
    their ids are merged with the documents, never broadcast."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) <> 1").select(F.col("doc_id").alias("_id")).distinct()
    known = docs.where("text is not null")
    return known.join(good.hint("merge"), F.col("doc_id") == F.col("_id"), "left_semi")


def bad_text(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents labelled as bad or as toxic."""
    bad = labels.where("quality = 0 or toxic = 1").select(F.col("doc_id").alias("_id")).distinct()
    known = docs.where("text is not null")
    return known.join(bad.hint("merge"), F.col("doc_id") == F.col("_id"), "left_semi")


# Words

# Hashes of the marks before and after a text.
_MARKS = (np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949D7C7509E6557))


def _mixed(seed: np.ndarray | np.uint64, value: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of one more bigint after what gave the seed."""
    one, two, three, four, five = (
        np.uint64(p)
        for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
    )

    def turned(x: np.ndarray, by: int) -> np.ndarray:
        return (x << np.uint64(by)) | (x >> np.uint64(64 - by))

    found = (seed + five + np.uint64(8)) ^ (turned(value * two, 31) * one)
    found = turned(found, 27) * one + four
    found = (found ^ (found >> np.uint64(33))) * two
    found = (found ^ (found >> np.uint64(29))) * three
    return found ^ (found >> np.uint64(32))


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """What each code point is to ``WORD``: 0 white space, 1 part of a word, 2 a word of its own."""
    kinds = np.full(0x110000, 2, np.uint8)
    for point, char in enumerate(map(chr, range(0x110000))):
        if char.isalnum() or char == "_":
            kinds[point] = 1
        elif char.isspace():
            kinds[point] = 0
    for first, last in re.findall("(.)-(.)", UNSPACED):
        kinds[ord(first) : ord(last) + 1] = 2
    return kinds


def _hashes(points: np.ndarray, places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each word: the sum of those of its characters, each with its place in the word."""
    mixed = _mixed(np.uint64(42), points.astype(np.uint64) | places.astype(np.uint64) << np.uint64(21))
    return np.add.reduceat(mixed, starts) if len(starts) else mixed[:0]


def _numbered(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]:
    """The words of all texts with their marks: for each its place among the distinct ones, the
    hashes of those, and those; which text each is of, and its place there."""
    lowered = [t.lower() for t in texts]
    joined = "\n".join(["", *lowered, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _kinds()[points]
    opens = kinds == 2
    opens[1:] |= (kinds[1:] == 1) & (kinds[:-1] != 1)
    starts = np.flatnonzero(opens)
    inside = np.flatnonzero(kinds)
    first = np.flatnonzero(opens[inside])
    lengths = np.diff(np.append(first, len(inside)))
    hashes = _hashes(points[inside], np.arange(len(inside)) - np.repeat(first, lengths), first)
    bounds = np.cumsum([0, *(len(t) + 1 for t in lowered)])
    sizes = np.diff(np.searchsorted(starts, bounds)) + 3
    of = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    place = np.arange(len(of)) - np.repeat(ends - sizes, sizes)
    words = place >= 2
    words[ends - 1] = False
    all_hashes = np.full(len(of), _MARKS[0], np.uint64)
    all_hashes[ends - 1] = _MARKS[1]
    all_hashes[words] = hashes
    begin, length = np.full(len(of), -1), np.zeros(len(of), np.int64)
    begin[words], length[words] = starts, lengths
    numbers, distinct = pd.factorize(all_hashes)
    some = np.empty(len(distinct), np.int64)
    some[numbers[::-1]] = np.arange(len(of))[::-1]
    spans = zip(begin[some].tolist(), length[some].tolist(), strict=True)
    return numbers, distinct, [joined[i : i + n] if i >= 0 else END for i, n in spans], of, place


def _spelling(words: Sequence[str], table: np.ndarray, own: np.ndarray, alphabet: str) -> np.ndarray:
    """What spelling each word and a blank after it costs, in units."""
    texts = [" " if w in (START, END) else w + " " for w in words]
    number, lengths = grams(texts, alphabet)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    each = table[number].astype(np.float64) + own[points]
    return np.rint(np.add.reduceat(each, np.cumsum(lengths) - lengths) * UNIT).astype(np.int64)


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of sorted ones, and how often each is there."""
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
    return ordered[starts], np.diff(np.append(starts, len(ordered)))


class Speller:
    """The model of characters, sent to the tasks compressed: what a symbol costs after others,
    and a character among those of its symbol."""

    def __init__(self, spark: SparkSession, table: np.ndarray, own: np.ndarray, alphabet: str):
        self.alphabet = alphabet
        self.shared = spark.sparkContext.broadcast(tuple(zlib.compress(x.tobytes(), 1) for x in (table, own)))

    def tables(self) -> tuple[np.ndarray, np.ndarray, str]:
        table, own = map(zlib.decompress, self.shared.value)
        return np.frombuffer(table, np.float16), np.frombuffer(own, np.float32), self.alphabet


TRIGRAMS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("n", pa.int64()), ("spelled", pa.int64())])


def trigram_counts(texts: DataFrame, speller: Speller) -> DataFrame:
    """(a, b, c, n, spelled): hashes of three words in a row, how often they are, and what the
    last one costs spelled; combined in each task before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = speller.tables()
        for piece in gathered(batches, "text", PIECE_BYTES):
            numbers, hashes, distinct, _, place = _numbered(piece.column("text").to_pylist())
            last = np.flatnonzero(place >= 2)
            # The first two words as one number, so that one sort tells trigrams apart.
            before, pairs = pd.factorize(numbers[last - 2] * len(distinct) + numbers[last - 1])
            found, n = _runs(np.sort(before * len(distinct) + numbers[last]))
            before, word = np.divmod(found, len(distinct))
            first, second = np.divmod(pairs[before], len(distinct))
            ids = hashes.view(np.int64)
            spelled = _spelling(distinct, *tables)
            yield arrow_table(TRIGRAMS, ids[first], ids[second], ids[word], n, spelled[word])

    rows = texts.select("text").mapInArrow(count, "a bigint, b bigint, c bigint, n bigint, spelled bigint")
    return rows.groupBy("a", "b", "c").agg(F.sum("n").alias("n"), F.max("spelled").alias("spelled"))


def _stored(df: DataFrame, path: str, *parts: str) -> DataFrame:
    """The rows as a table at the path, compressed well, in folders by the columns ``parts``."""
    df.write.option("compression", "zstd").partitionBy(*parts).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_values(
    counts: DataFrame, rounds: int = 2, odds: DataFrame | None = None, folder: str | None = None, counted: str | None = None
) -> DataFrame:
    """What each gram, by the hash of its words' hashes, adds to the log probability of a text
    beyond its spelling, in units: (key, value), with the rows (key, odds) as ``packed_values``.

    With p of each order interpolated with the order below by the weight w of its context, and
    the lowest order with the spelling, the log probability of a word is that of its spelling
    plus, order by order, log w of the context if it was seen and log p - log (w * lower p) of
    the gram if it was seen. A gram's value is the sum of both, as it is the context of what
    follows; what was never seen adds nothing. The empty context has the key ``WORDS``.

    A round takes the bigrams that begin with some words and the trigrams with these in the
    middle: their contexts and lower orders are of the same round. The rows are in ``folder``,
    if it is given; the folder ``counted`` is deleted once its texts are counted.
    """
    spark = counts.sparkSession
    folder = folder or work_folder(spark, "values")
    part = F.pmod("b", F.lit(rounds)).cast("int")
    threes, words = [], []
    for some in range(min(COUNT_ROUNDS, rounds)):
        path = work_folder(spark, "trigrams")
        # Rows of one bigram lie together and in order, which compresses them.
        found = counts.withColumn("_part", part).where(F.col("_part") % min(COUNT_ROUNDS, rounds) == some)
        threes.append((_stored(found.sortWithinPartitions("_part", "b", "c", "a"), path, "_part"), path))
        # A word has its bigrams in any round; how many of these are seen how often is added up.
        seen = _bigrams(threes[-1][0]).groupBy("c").agg(F.count("*").alias("n"), F.max("spelled").alias("spelled"), *_counts_of_counts())
        words.append((_stored(seen, path := work_folder(spark, "words")), path))
    if counted:
        files.delete(spark, counted)
    three, one = reduce(DataFrame.unionByName, [t for t, _ in threes]), reduce(DataFrame.unionByName, [w for w, _ in words])
    twice = _discounts(one.agg(*(F.sum(f"_n{k}") for k in (1, 2, 3, 4))).first())
    rest = [work_folder(spark, name) for name in ("words", "shares")]
    one = _stored(one.groupBy("c").agg(F.sum("n").alias("n"), F.max("spelled").alias("spelled")), rest[0])
    for _, path in words:
        files.delete(spark, path)
    found = [discounts(one), twice, discounts(three)]
    sums = written(_contexts(one, [], found[0]), "contexts")
    spelled = one.withColumn("_lower", F.exp(-F.col("spelled") / UNIT)).crossJoin(F.broadcast(sums))
    lower = _stored(_shares(spelled, ["c"], found[0]), rest[1])
    first = [sums.select(F.lit(WORDS).cast("bigint").alias("key"), F.log("_weight").alias("value")), _gains(lower, ["c"])]
    packed_values(reduce(DataFrame.unionByName, first), folder, odds)
    for r in range(rounds):
        rows, path = threes[r % len(threes)]
        rows, values, below, done = rows.where(F.col("_part") == r).drop("spelled"), [], lower, [f"{path}/_part={r}"]
        two = rows.groupBy("b", "c").agg(F.count("*").alias("n"))
        for rows, words, discount in ((two, ["b", "c"], found[1]), (rows, ["a", "b", "c"], found[2])):
            context = words[:-1]
            done += [work_folder(spark, name) for name in ("contexts", "shares")]
            sums = _stored(_contexts(rows, context, discount), done[-2])
            joined = rows.join(sums.hint("merge"), context)
            joined = joined.join(below.select(*words[1:], F.col("_p").alias("_lower")).hint("merge"), words[1:])
            below = _stored(_shares(joined, words, discount), done[-1])
            values += [sums.select(F.xxhash64(*context).alias("key"), F.log("_weight").alias("value")), _gains(below, words)]
        blocks = packed_values(reduce(DataFrame.unionByName, values), folder)
        for path in done:
            files.delete(spark, path)
    for path in rest:
        files.delete(spark, path)
    return blocks


def _bigrams(trigrams: DataFrame) -> DataFrame:
    return trigrams.groupBy("b", "c").agg(F.count("*").alias("n"), F.max("spelled").alias("spelled"))


def _contexts(table: DataFrame, context: list[str], found: tuple[float, float, float]) -> DataFrame:
    """The counts of what follows each context, and the weight of the order below."""
    sums = table.groupBy(*context).agg(F.sum("n").alias("_total"), F.sum(_by_count(*map(F.lit, found))).alias("_taken"))
    return sums.withColumn("_weight", F.greatest(F.col("_taken") / F.col("_total"), F.lit(LEAST))).drop("_taken")


def _shares(joined: DataFrame, words: list[str], found: tuple[float, float, float]) -> DataFrame:
    """Each gram's probability and what the order below has in it."""
    rest = F.greatest(F.col("_weight") * F.col("_lower"), F.lit(1e-300))
    share = (F.col("n") - _by_count(*map(F.lit, found))) / F.col("_total")
    return joined.select(*words, (share + rest).alias("_p"), rest.alias("_rest"))


def _gains(shares: DataFrame, words: list[str]) -> DataFrame:
    return shares.select(F.xxhash64(*words).alias("key"), F.log(F.col("_p") / F.col("_rest")).alias("value"))


# Rows of packed numbers


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as bytes, all first bytes before all second ones, without those that are zero in
    all numbers, compressed. ``unpacked`` gives the numbers back as unsigned ones."""
    numbers = np.ascontiguousarray(numbers).astype(np.uint64, copy=False)
    width = (int(numbers.max(initial=0)).bit_length() + 7) // 8
    planes = numbers.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return np.array([len(numbers), width], np.uint32).tobytes() + pa.compress(planes, "zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n, width = np.frombuffer(data[:8], np.uint32).tolist()
    planes = np.zeros((n, 8), np.uint8)
    if n and width:
        found = pa.decompress(data[8:], decompressed_size=n * width, codec="zstd", asbytes=True)
        planes[:, :width] = np.frombuffer(found, np.uint8).reshape(width, n).T
    return planes.view(np.uint64).reshape(-1)


def _signed(numbers: np.ndarray) -> np.ndarray:
    """Signed numbers as unsigned ones, small as small ones; ``_unsigned`` turns them back."""
    return ((numbers << 1) ^ (numbers >> 63)).view(np.uint64)


def _unsigned(numbers: np.ndarray) -> np.ndarray:
    return (numbers >> np.uint64(1)).view(np.int64) ^ -(numbers & np.uint64(1)).view(np.int64)


PACKED = pa.schema([("shard", pa.int32()), *((x, pa.binary()) for x in ("keys", "numbers", "odds"))])
PACKED_ROWS = "shard int, keys binary, numbers binary, odds binary"


def _row(shard: pa.ChunkedArray, keys: np.ndarray, worth: np.ndarray, odds: np.ndarray) -> pa.Table:
    """Sorted keys, values in units and odds, if there are any, of a shard as one row."""
    lists = packed(np.diff(keys, prepend=np.uint64(0))), packed(_signed(worth)), None if np.isnan(odds).all() else odds.tobytes()
    return pa.table([shard[:1], *([x] for x in lists)], schema=PACKED)


def _summed(keys: np.ndarray, worth: np.ndarray, odds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its values and its odds."""
    order = np.argsort(keys)
    keys, n = _runs(keys[order])
    starts = np.cumsum(n) - n
    return keys, np.add.reduceat(worth[order], starts), np.fmax.reduceat(odds[order], starts)


def _values(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys, values and odds of a shard's rows, each key once."""
    keys = [_keys(x) for x in rows.column("keys")] or [np.zeros(0, np.uint64)]
    worth = [_unsigned(unpacked(x.as_py())) for x in rows.column("numbers")] or [np.zeros(0, np.int64)]
    odds = [np.full(len(k), np.nan) if x is None else np.frombuffer(x) for k, x in zip(keys, rows.column("odds").to_pylist() or [None], strict=True)]
    found = tuple(map(np.concatenate, (keys, worth, odds)))
    return _summed(*found) if len(keys) > 1 else found


def packed_values(values: DataFrame, folder: str, odds: DataFrame | None = None) -> DataFrame:
    """The rows (key, value), value in nats, and (key, odds) by shard, as packed numbers. A key
    may be in several rows of the folder, of which all are returned."""
    rows = values.select("key", F.round(F.col("value") * UNIT).cast("bigint").alias("value"), F.lit(None).cast("double").alias("odds"))
    if odds is not None:
        rows = rows.unionByName(odds.select("key", F.lit(0).cast("bigint").alias("value"), "odds"))
    rows = rows.withColumn("shard", F.shiftrightunsigned("key", 64 - SHARD_BITS).cast("int"))

    def pack(group: pa.Table) -> pa.Table:
        keys, worth, odds = (group.column(x).to_numpy() for x in ("key", "value", "odds"))
        return _row(group.column("shard"), *_summed(keys.view(np.uint64), worth, odds))

    blocks = rows.groupBy("shard").applyInArrow(pack, PACKED_ROWS).withColumn("_part", F.col("shard") % MERGES)
    blocks.write.partitionBy("_part").mode("append").parquet(folder)
    return values.sparkSession.read.schema(blocks.schema).parquet(folder)


def merged_values(blocks: DataFrame, folder: str, name: str, path: str) -> DataFrame:
    """The rows of ``packed_values`` as one of each shard, in the table at the path by buckets of the shard,
    which no join needs to shuffle. The folder of ``blocks`` is emptied by and by."""
    spark = blocks.sparkSession

    def merge(group: pa.Table) -> pa.Table:
        return _row(group.column("shard"), *_values(group))

    for part in range(MERGES):
        some = blocks.where(F.col("_part") == part).drop("_part").groupBy("shard").applyInArrow(merge, PACKED_ROWS)
        writer = some.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard").mode("append")
        writer.option("compression", "zstd").option("path", path).saveAsTable(name)
        files.delete(spark, f"{folder}/_part={part}")
    # A table read before rows were added has only the files of then.
    return spark.table(name)


GRAMS = pa.schema([("shard", pa.int32()), ("at", pa.int64()), ("texts", pa.list_(pa.int64())), *((x, pa.binary()) for x in ("keys", "sizes", "owners", "counts"))])


def text_grams(rows: DataFrame, speller: Speller, part: int = 0, parts: int = 1) -> DataFrame:
    """For each shard of the grams of a task's piece: the sorted keys, the number of distinct texts
    that each is in, which of the piece's these are, and how often each has it, as packed numbers.
    ``at`` numbers the piece's texts, whose _text the first shard lists. Under the key ``SPELLED``
    the counts are the costs of spelling, under ``WORDS`` those of words. Only every so manieth
    shard is there if there are ``parts``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = speller.tables()
        first = TaskContext.get().partitionId() << 44
        for number, piece in enumerate(gathered(batches, "text", PIECE_BYTES)):
            texts = dict(zip(piece.column("_text").to_pylist(), piece.column("text").to_pylist(), strict=True))
            every = np.arange(len(texts))
            numbers, hashes, distinct, of, place = _numbered(list(texts.values()))
            spelled = np.bincount(of, _spelling(distinct, *tables)[numbers] * (place >= 2), len(texts))
            hashed = hashes[numbers]
            singles = _mixed(np.uint64(42), hashed)
            pairs = _mixed(singles[:-1], hashed[1:])
            triples = _mixed(pairs[:-1], hashed[2:])
            later, last = place >= 1, place >= 2
            keys = np.concatenate([singles[later], pairs[later[1:]], triples[last[2:]]])
            owners = np.concatenate([of[later], of[1:][later[1:]], of[2:][last[2:]]])
            if parts > 1:
                some = (keys >> np.uint64(64 - SHARD_BITS)) % np.uint64(parts) == part
                keys, owners = keys[some], owners[some]
            codes, keys = pd.factorize(keys)
            order = np.argsort(keys)
            rank = np.empty(len(keys), np.int64)
            rank[order] = np.arange(len(keys))
            found, n = _runs(np.sort(rank[codes] * len(texts) + owners))
            code, owner = np.divmod(found, len(texts))
            lists = [keys[order], np.bincount(code, minlength=len(keys)), owner, n]
            if part == 0:
                own = [np.array([SPELLED, WORDS], np.uint64), np.full(2, len(texts)), np.tile(every, 2)]
                own.append(np.concatenate([np.rint(spelled).astype(np.int64), np.bincount(of[last], minlength=len(texts))]))
                lists = [np.concatenate(x) for x in zip(own, lists, strict=True)]
            keys, sizes, owner, n = lists
            cuts = np.searchsorted(keys, np.arange(1, SHARDS, dtype=np.uint64) << np.uint64(64 - SHARD_BITS))
            cuts = np.concatenate(([0], cuts, [len(keys)]))
            ends = np.concatenate(([0], np.cumsum(sizes)))
            found = {name: [] for name in GRAMS.names}
            for shard in np.flatnonzero(np.diff(cuts)).tolist():
                here = slice(cuts[shard], cuts[shard + 1])
                there = slice(ends[cuts[shard]], ends[cuts[shard + 1]])
                row = shard, first | number << 24, list(texts) if shard == 0 else None, np.diff(keys[here], prepend=np.uint64(0)), sizes[here], owner[there], n[there]
                for (name, into), x in zip(found.items(), row, strict=True):
                    into.append(packed(x) if name in GRAMS.names[3:] else x)
            yield pa.RecordBatch.from_pydict(found, GRAMS)

    kinds = "shard int, at bigint, texts array<bigint>, keys binary, sizes binary, owners binary, counts binary"
    return rows.select("_text", "text").mapInArrow(count, kinds)


def _keys(data: pa.Scalar) -> np.ndarray:
    return np.cumsum(unpacked(data.as_py()), dtype=np.uint64)


def _places(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the sorted keys are among others, and where."""
    places = np.searchsorted(among, keys)
    found = places < len(among)
    found[found] = among[places[found]] == keys[found]
    return found, places[found]


def evidence(bad: DataFrame, good: DataFrame) -> DataFrame:
    """(key, _1, _0): how many texts of two results of ``text_grams`` have each gram of the first."""

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("key", pa.int64()), ("_1", pa.int64()), ("_0", pa.int64())])
        if not left.num_rows:
            return schema.empty_table()
        keys = np.concatenate([_keys(x) for x in left.column("keys")])
        sizes = np.concatenate([unpacked(x.as_py()) for x in left.column("sizes")]).view(np.int64)
        order = np.argsort(keys)
        keys, n = _runs(keys[order])
        ones, zeros = np.add.reduceat(sizes[order], np.cumsum(n) - n), np.zeros(len(keys), np.int64)
        for listed, sizes in zip(right.column("keys"), right.column("sizes"), strict=True):
            found, places = _places(_keys(listed), keys)
            zeros[places] += unpacked(sizes.as_py()).view(np.int64)[found]
        return pa.table([keys.view(np.int64), ones, zeros], schema=schema)

    both = bad.select("shard", "keys", "sizes").groupBy("shard").cogroup(good.select("shard", "keys", "sizes").groupBy("shard"))
    return both.applyInArrow(count, "key bigint, _1 bigint, _0 bigint")


def log_odds(counts: DataFrame) -> DataFrame:
    """(key, odds) of the counts of ``evidence``: the log odds that a text with the gram is one of
    the bad, less some standard errors; only what stays above zero."""
    texts = counts.where(F.col("key") == SPELLED).select(F.col("_1").alias("_all1"), F.col("_0").alias("_all0"))
    rates = [F.log((F.col(f"_{kind}") + 0.5) / (F.col(f"_all{kind}") + 1)) for kind in (1, 0)]
    error = F.sqrt(1 / (F.col("_1") + 0.5) + 1 / (F.col("_0") + 0.5))
    odds = rates[0] - rates[1] - ERRORS * error
    found = counts.where(~F.col("key").isin(SPELLED, WORDS) & (F.col("_1") > 0)).crossJoin(F.broadcast(texts))
    return found.select("key", odds.alias("odds")).where("odds > 0")


def text_costs(found: DataFrame, values: DataFrame) -> DataFrame:
    """(_text, _sum, _odds): minus the log probability of each distinct text, in nats, and the
    highest odds of its grams if ``values`` has them. Each shard's grams meet its values in one
    task, which sums for each piece; a text that several pieces have costs the same in each."""

    def cost(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = {name: [] for name in ("at", "texts", "costs", "odds")}
        if left.num_rows:
            keys, worth, odds = _values(right)
            if left.column("shard")[0].as_py() == 0:
                keys, worth, odds = np.append(np.uint64(SPELLED), keys), np.append(-1, worth), np.append(np.nan, odds)
        for row in left.select(["at", "texts", "keys", "sizes", "owners", "counts"]).to_pylist():
            here, places = _places(np.cumsum(unpacked(row["keys"]), dtype=np.uint64), keys)
            sizes = unpacked(row["sizes"]).view(np.int64)
            pairs = np.repeat(here, sizes)
            owners, counts = (unpacked(row[x]).view(np.int64)[pairs] for x in ("owners", "counts"))
            gram = np.repeat(places, sizes[here])
            rows["at"].append(row["at"])
            rows["texts"].append(row["texts"])
            # Whole numbers below 2**53, of which any sum of doubles is exact.
            rows["costs"].append(packed(_signed(np.bincount(owners, -worth[gram] * counts).astype(np.int64))))
            telling = np.flatnonzero(~np.isnan(odds[gram]))
            most = np.full(owners[telling].max(initial=-1) + 1, np.nan)
            np.fmax.at(most, owners[telling], odds[gram[telling]])
            rows["odds"].append(most.tobytes() if len(most) else None)
        return pa.table(rows, pa.schema([("at", pa.int64()), ("texts", pa.list_(pa.int64())), ("costs", pa.binary()), ("odds", pa.binary())]))

    def total(group: pa.Table) -> pa.Table:
        texts = next(x.as_py() for x in group.column("texts") if x.is_valid)
        costs, odds = np.zeros(len(texts), np.int64), np.full(len(texts), np.nan)
        for row in group.select(["costs", "odds"]).to_pylist():
            some = _unsigned(unpacked(row["costs"]))
            costs[: len(some)] += some
            if row["odds"] is not None:
                some = np.frombuffer(row["odds"])
                odds[: len(some)] = np.fmax(odds[: len(some)], some)
        schema = pa.schema([("_text", pa.int64()), ("_cost", pa.int64()), ("_odds", pa.float64())])
        return pa.table([texts, costs, pa.array(odds, from_pandas=True)], schema=schema)

    both = found.groupBy("shard").cogroup(values.groupBy("shard")).applyInArrow(cost, "at bigint, texts array<bigint>, costs binary, odds binary")
    sums = both.groupBy("at").applyInArrow(total, "_text bigint, _cost bigint, _odds double")
    sums = sums.groupBy("_text").agg(F.max("_cost").alias("_cost"), F.max("_odds").alias("_odds"))
    return sums.select("_text", "_odds", (F.col("_cost") / UNIT).alias("_sum"))


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files are deleted when the write that made them ends."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, perplexity, threshold, fluent, clear and kept of each row of ``docs``.

    Perplexity is that of a character; null and empty texts have none and are not kept. A
    document is ``fluent`` if its cross-entropy passes, ``clear`` if the evidence of its grams
    does, and kept if it is both.
    ``threshold`` is the cross-entropy in nats that the language's documents may have, steadied
    by ``STEADY`` symbols of the language's average; a language without trusted documents,
    null among them, takes the threshold of all trusted documents together. Without any
    trusted document nothing can be told apart and every text is kept. Repeated labels count
    once; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    with _cleaned(docs.sparkSession):
        return _classified(docs, labels)


def _classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.xxhash64("text").alias("_text"),
        "text",
    )
    held = F.pmod("_text", F.lit(HELD_OUT)) == 0
    # Labels are joined with whole texts, so once only.
    trusted, other = (work_folder(spark, name) for name in ("trusted", "bad"))
    learnt = _stored(trusted_text(rows, labels).where(~held).select("text"), trusted)
    bad = _stored(bad_text(rows, labels).where(~held).select("text"), other)
    counts = written(characters(rows), "characters")
    chars = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    alphabet = _alphabet(counts)
    table = costs(*probabilities(gram_counts(learnt, alphabet)))
    speller = Speller(spark, table, shares_of_symbols(counts, alphabet), alphabet)
    folder = work_folder(spark, "evidence")
    parts = EVIDENCE_ROUNDS if chars > VALUE_CHARS else 1
    for part in range(parts):
        # Each document counts, whichever pieces its copies come to.
        found = evidence(*(text_grams(x.withColumn("_text", F.monotonically_increasing_id()), speller, part, parts) for x in (bad, learnt)))
        found.write.option("compression", "zstd").mode("append").parquet(folder)
    odds = written(log_odds(spark.read.schema(found.schema).parquet(folder)), "odds")
    for done in (folder, other):
        files.delete(spark, done)
    rounds = min(VALUE_ROUNDS, 1 + chars // VALUE_CHARS)
    folder = work_folder(spark, "values")
    name, path = f"values_{uuid.uuid4().hex}", work_folder(spark, "merged")
    values = merged_values(word_values(trigram_counts(learnt, speller), rounds, odds, folder, trusted), folder, name, path)
    rounds = min(TEXT_ROUNDS, 1 + chars // TEXT_CHARS)
    folder = work_folder(spark, "costs")
    for some in range(rounds):
        # Not by the low bits, as held-out texts are told by those of the same hash.
        texts = rows.where("length(text) > 0").where(F.pmod(F.shiftright("_text", 20), F.lit(rounds)) == some)
        sums = text_costs(text_grams(texts, speller), values)
        sums.write.mode("append").parquet(folder)
    sums = spark.read.schema(sums.schema).parquet(folder)
    spark.sql(f"DROP TABLE {name}")
    files.delete(spark, path)
    scored = rows.select("doc_id", "lang", "_text", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("_n"))
    scored = scored.join(sums.hint("merge"), "_text", "left").withColumn("_sum", F.coalesce("_sum", F.lit(0.0))).withColumn("_held", held)
    scored = scored.withColumn("_odds", F.round(F.coalesce("_odds", F.lit(0.0)), 2))
    scored = written(scored, "scored")
    judged = written(trusted_text(scored.withColumn("text", F.lit("")), labels), "judged")
    limits = written(thresholds(judged), "limits")
    most = judged.groupBy("_held").agg(F.percentile("_odds", EVIDENCE_QUANTILE).alias("_most"))
    most = most.agg(F.max_by("_most", "_held").alias("_most"))
    everything = limits.where("_all").select(F.col("threshold").alias("_t"), F.col("mean").alias("_m"))
    own = limits.where("not _all").select(F.col("lang").alias("_lang"), "threshold", "mean")
    joined = scored.join(own, F.col("lang") == F.col("_lang"), "left").join(F.broadcast(everything), F.lit(True), "left")
    joined = joined.join(F.broadcast(most), F.lit(True), "left")
    threshold = F.coalesce("threshold", "_t")
    cross = (F.col("_sum") + STEADY * F.coalesce("mean", "_m")) / (F.col("_n") + STEADY)
    some = F.col("_n") > 0
    judged = joined.select(
        "doc_id",
        "lang",
        F.when(some, F.exp(F.col("_sum") / F.col("_n"))).alias("perplexity"),
        threshold.alias("threshold"),
        (some & F.coalesce(cross <= threshold, F.lit(True))).alias("fluent"),
        (some & F.coalesce(F.col("_odds") <= F.col("_most"), F.lit(True))).alias("clear"),
    )
    return judged.withColumn("kept", F.col("fluent") & F.col("clear"))


def thresholds(scored: DataFrame) -> DataFrame:
    """(lang, mean, threshold, _all): for each language and, where ``_all``, for all together the
    mean cross-entropy of a character and the quantile of the documents', with an allowance for
    few documents. Only held-out documents count where there are any. The quantile is found in
    a histogram with steps of ``STEP``."""
    both = scored.where("_n > 0").select("lang", "_sum", "_n", "_held", F.explode(F.array(F.lit(True), F.lit(False))).alias("_all"))
    both = both.withColumn("lang", F.when(~F.col("_all"), F.col("lang"))).where("_all or lang is not null")
    group = ["_all", "lang"]
    means = both.groupBy(*group, "_held").agg((F.sum("_sum") / F.sum("_n")).alias("mean"), F.count("*").alias("_docs"))
    means = means.groupBy(*group).agg(F.max(F.struct("_held", "mean", "_docs")).alias("_best"))
    means = written(means.select(F.col("_all").alias("_a"), F.col("lang").alias("_l"), "_best.*").withColumnRenamed("_held", "_h"), "means")
    same = (F.col("_all") == F.col("_a")) & F.col("lang").eqNullSafe(F.col("_l")) & (F.col("_held") == F.col("_h"))
    joined = both.join(means, same)
    cross = (F.col("_sum") + STEADY * F.col("mean")) / (F.col("_n") + STEADY)
    bucket = F.ceil(cross / STEP).alias("_bucket")
    counts = joined.groupBy(*group, "mean", "_docs", bucket).agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*group).orderBy("_bucket"))
    enough = counts.withColumn("_upto", upto).where(F.col("_upto") >= F.ceil(QUANTILE * F.col("_docs")))
    limit = F.min("_bucket") * STEP + ALLOWANCE / F.sqrt(F.max("_docs"))
    return enough.groupBy(*group, "mean").agg(limit.alias("threshold"))
