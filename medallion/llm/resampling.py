"""Importance resampling of documents towards a target distribution.

Documents and target texts are bags of word runs hashed into buckets. A bucket's gain is the log
ratio of its smoothed shares in the target and in all documents; a document's weight is the mean
gain of its features, and Gumbel noise that its id decides turns the weights into a draw without
replacement: the highest scores are drawn.

Features are hashed and scored in arrays: the bytes of a batch are cut into words at once, CRC-32
runs over all words side by side, and a run of two words goes on from the state after the first.
Counts are summed in each task, so that a task sends at most one number per bucket, and the gains
that come back are as many.

The scores are ranked by a distributed radix sort, least significant digit first, over a composite
key of score, id and number of features. Each pass is a stable counting sort: counts per digit and
block, prefix sums over digits and blocks, and the place that follows from them for each row. A
pass is written before the next one reads it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import arrow_table, bounded_batches, gathered, unused, written
from medallion.llm.counting import block_of_row_id, counting_pass, digits, field
from medallion.session import work_folder
from medallion.sources import files

BUCKETS = 10_000
SCALE = 1_000
LONGEST_RUN = 2
PERCENT, MIN_WORDS, SEED = 25, 20, 7
BATCH_BYTES = 4_000_000
# Longer words are hashed one by one.
LONG_WORD = 64
ALL_ONES = 0xFFFFFFFF


# Features


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC = _crc_table()
BYTES = np.arange(256)
LOWER = np.where((BYTES >= 65) & (BYTES <= 90), BYTES + 32, BYTES).astype(np.uint8)
IN_WORD = ((BYTES >= 48) & (BYTES <= 57)) | ((BYTES >= 97) & (BYTES <= 122)) | (BYTES >= 128)


def _step(states: np.ndarray, data: np.ndarray) -> np.ndarray:
    return CRC[(states ^ data) & 255] ^ (states >> 8)


def _run(states: np.ndarray, data: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The states after the bytes of the words."""
    states = states.copy()
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        word = data[begin[i] : begin[i] + sizes[i]].tobytes()
        states[i] = zlib.crc32(word, int(states[i]) ^ ALL_ONES) ^ ALL_ONES
    order = np.argsort(np.where(sizes > LONG_WORD, 0, -sizes), kind="stable")
    ordered, at, left = states[order], begin[order], sizes[order]
    left = np.where(left > LONG_WORD, 0, left)
    for position in range(int(left.max(initial=0))):
        n = int(np.searchsorted(-left, -position))  # words with a byte at this position
        ordered[:n] = _step(ordered[:n], data[at[:n] + position])
    states[order] = ordered
    return states


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and buckets of all features of the texts, and each text's number of words.

    A word is a run of digits, letters a to z, in lower case, and characters beyond ASCII, whose
    bytes in UTF-8 are all above 127; so words can be cut in bytes.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    data = LOWER[held]
    inside = IN_WORD[data]
    before, after = np.roll(inside, 1), np.roll(inside, -1)
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    if len(data):
        before[0] = after[-1] = False
    before[edges] = after[edges - 1] = False
    begin, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(offsets, begin, side="right") - 1
    words = np.bincount(row, minlength=len(texts))
    states = _run(np.full(len(begin), ALL_ONES, np.uint32), data, begin, end - begin)
    pairs = np.flatnonzero(row[1:] == row[:-1])
    blank = _step(states[pairs], np.full(len(pairs), 32, np.uint8))
    both = _run(blank, data, begin[pairs + 1], (end - begin)[pairs + 1])
    hashes = np.concatenate([states, both]) ^ np.uint32(ALL_ONES)
    return np.concatenate([row, row[pairs]]), (hashes % np.uint32(buckets)).astype(np.int64), words


# Weights


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of the column ``text`` fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for some in gathered(batches, "text", BATCH_BYTES):
            total += np.bincount(features(some.column("text"), buckets)[1], minlength=buckets)
        found = np.flatnonzero(total)
        schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
        yield arrow_table(schema, found.astype(np.int32), total[found])

    counts = texts.select("text").mapInArrow(count, "bucket int, n bigint")
    summed = np.zeros(buckets, np.int64)
    # One row per bucket.
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        summed[row["bucket"]] = row["n"]
    return summed


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket from its counts in all documents and in the target."""
    every, wanted = float(documents.sum() + len(documents)), float(target.sum() + len(target))
    shares = zip(documents.tolist(), target.tolist(), strict=True)
    ratios = [(t + 1) * every / ((s + 1) * wanted) for s, t in shares]
    return np.array([math.floor(SCALE * math.log(r)) for r in ratios], np.int64)


WEIGHTED = pa.schema(
    [("doc_id", pa.int64()), ("_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())]
)
WEIGHTED_DDL = "doc_id bigint, _words bigint, n_features bigint, weight bigint"


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, number of words and of features, and the floored mean gain of the features."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in gathered(batches, "text", BATCH_BYTES):
            row, bucket, words = features(some.column("text"), len(gain))
            # Whole numbers far below 2**53: the sums are exact.
            sums = np.bincount(row, weights=gain[bucket], minlength=some.num_rows).astype(np.int64)
            many = np.maximum(LONGEST_RUN * words - 1, 0)
            mean = np.where(many > 0, sums // np.maximum(many, 1), 0)
            yield arrow_table(WEIGHTED, some.column("doc_id"), words, many, mean)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(weigh, WEIGHTED_DDL)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise that the id decides; a null id counts as an empty one."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    uniform = (h.cast("double") + 0.5) / float(1 << 32)
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log(uniform))).cast("bigint")


# Ranks


def ranked(rows: DataFrame, fields: list[tuple]) -> DataFrame:
    """``rows``, a written table with a unique ``_place`` of ``monotonically_increasing_id``,
    with dense places from 0 in the order of a composite key instead; rows with equal keys keep
    their order. See ``counting.digits`` for ``fields``."""
    state, before = rows.withColumn("_block", block_of_row_id("_place")), None
    # Without any bit to sort by a pass still makes the places dense.
    for digit in digits(fields) or [F.lit(0)]:
        path = work_folder(rows.sparkSession, "pass")
        counting_pass(state.withColumn("_digit", digit), "_digit", "_block", "_place").write.parquet(path)
        # The pass before is not read again.
        if before:
            files.delete(rows.sparkSession, before)
        state, before = rows.sparkSession.read.schema(state.schema).parquet(path), path
    return state.drop("_block")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of each row of ``docs``.

    Of the N documents with at least ``min_words`` words ``percent`` per cent, rounded down, are
    drawn and ranked from 1 by score, downwards; the rank of others is null. Equal scores go to
    the smaller id, null last, and rows of one id to that of fewer features. Null texts and those
    without words have no features and weight 0. Repeated rows are rows; an empty table gives
    no rows, an empty target weights from smoothing alone. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = weights(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = written(scored.withColumn("_place", F.monotonically_increasing_id()), "scored")
    fit = scored.where(F.col("_words") >= min_words).drop("_words")
    of = fit.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("doc_id").isNull()).alias("nulls"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("score", "doc_id", "n_features") for f in (F.min, F.max)],
    ).first()
    result = ["doc_id", "n_features", "weight", "score"]
    unfit = scored.where(F.col("_words") < min_words).select(*result, F.lit(None).cast("bigint").alias("rank"))
    if not of["n"]:
        return unfit
    drawn = percent * of["n"] // 100
    known = F.coalesce("doc_id", F.lit(of["min_doc_id"] or 0))
    fields = [
        field(-F.col("score"), -of["max_score"], -of["min_score"]),
        (F.col("doc_id").isNull().cast("bigint"), 1 if of["nulls"] else 0),
        field(known, of["min_doc_id"] or 0, of["max_doc_id"] or 0),
        field(F.col("n_features"), of["min_n_features"], of["max_n_features"]),
    ]
    places = ranked(fit, fields)
    rank = F.when(F.col("_place") < drawn, F.col("_place") + 1)
    return places.select(*result, rank.alias("rank")).unionByName(unfit)


def drawn(docs: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` whose id is drawn, all columns, with their ``rank`` (or, where there
    is such a column, ``_rank``); of rows with one id each gets the smallest rank of that id.
    Rows without id are not among them. See ``resample``."""
    rank = unused(docs, "rank")
    ranks = resample(docs, target, **parameters).where("rank is not null and doc_id is not null")
    ranks = ranks.groupBy(F.col("doc_id").alias("_drawn")).agg(F.min("rank").alias(rank))
    joined = docs.join(ranks, docs["doc_id"] == ranks["_drawn"])
    return joined.select(*[docs[c] for c in docs.columns], ranks[rank])


ORACLE = r"""
WITH RECURSIVE bits AS (
    SELECT range AS byte, range AS c, 0 AS step FROM range(256)
    UNION ALL
    SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1
    FROM bits WHERE step < 8
), crc AS (
    SELECT list(c ORDER BY byte) AS t FROM bits WHERE step = 8
), texts AS (
    SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
    UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark
), worded AS (
    SELECT side, r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM texts
), features AS (
    SELECT side, r, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS feature
    FROM worded
), hashed AS (
    SELECT feature, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, [('0x' || substr(h, 2 * i + 1, 2))::BIGINT FOR i IN range(len(h) // 2)]),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 10000 AS bucket
    FROM (SELECT DISTINCT feature, hex(encode(feature)) AS h FROM features), crc
), counted AS (
    SELECT side, r, bucket, count(*) AS n FROM features JOIN hashed USING (feature) GROUP BY ALL
), sums AS (
    SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t
    FROM counted GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln(
        (t + 1)::DOUBLE * ((SELECT sum(s) FROM sums) + 10000)
        / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM sums) + 10000))))::BIGINT AS gain
    FROM sums
), means AS (
    SELECT r, sum(n)::BIGINT AS n, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
    FROM counted JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r
), scored AS (
    SELECT doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
    FROM worded LEFT JOIN means USING (r) WHERE side = 'd'
), final AS (
    SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored
), fit AS (
    SELECT *, row_number() OVER (ORDER BY score DESC, doc_id, n_features) AS place, count(*) OVER () AS many
    FROM final WHERE words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * many // 100 THEN place END AS rank
FROM fit
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM final WHERE words < 20
"""
