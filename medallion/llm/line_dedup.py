"""Near-duplicate lines by a segment-partition edit join, in DataFrame functions only.

Lines within ``MAX_EDITS`` edits of each other are links. A line is cut into one segment more
than edits are allowed, so that each line within reach has at least one segment of it
unchanged, shifted by no more than the edits before or after it allow. Segments are indexed
under the line's length and the segment's number; a line probes the index of each length that
it may be near to, at the few places where such a segment can be. Equal lines are one row
before this, keys are hashes, and a candidate pair is met once. What the counts of a few
letters can rule out goes first; the rest is verified on the whole lines by a banded edit
distance whose band is a word of bits. Where a segment is common to very many lines, as in
boilerplate, these meet by all but two of several pieces instead, and only if few of their runs
of letters differ, see ``crowd_pairs``. Lines too short for two edits to mean a typing error are
classed by equality alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import written
from medallion.llm.components import components

MAX_EDITS = 2
# Shorter lines, blanks at the ends not counted, are duplicates of equal ones only.
MIN_CHARS = 30
SEGMENTS = MAX_EDITS + 1
# Lines with a segment in common beyond which they are compared by pieces, and those pieces.
CROWD = 16
PIECES = 5
# Lengths of the runs of letters of which lines of a crowd keep the parities, and the words of 64
# bits for each.
RUNS = {1: 1, 2: 4, 3: 4}
# Letters that a line's sketch counts, a byte for each.
SKETCHED = "etaoinsr"


def probes() -> list[tuple[int, int, int]]:
    """(how much shorter, segment, shift) for all places where a line is to be probed.

    Left of the segment there may be as many edits as segments, or one of those would be found;
    the same holds to its right, where the difference in length counts.
    """
    found = []
    for shorter in range(MAX_EDITS + 1):
        for number in range(1, SEGMENTS + 1):
            left, right = number - 1, SEGMENTS - number
            low, high = max(-left, shorter - right), min(left, shorter + right)
            found += [(shorter, number, shift) for shift in range(low, high + 1)]
    return found


def _keyed(lines: DataFrame, places: list[tuple[int, int, int]], name: str) -> DataFrame:
    """Ids of the lines, under that name, with the hash keys of their text at the places; places
    that a line is too short for have none.

    A line of n code points has segments of n div SEGMENTS, the last n % SEGMENTS one longer.
    They are cut out of its UTF-32 form, where places need not be counted out.
    """
    listed = F.array(*[F.struct(*map(F.lit, place)) for place in places])
    rows = lines.select("_id", "_length", F.encode("_line", "UTF-32").alias("_code"))
    rows = rows.select("*", F.inline(listed).alias("_shorter", "_number", "_shift"))
    rows = rows.withColumn("_other", F.expr("_length - _shorter")).where(F.col("_other") >= MIN_CHARS)
    rows = rows.withColumn("_base", F.expr(f"int(_other div {SEGMENTS})"))
    rows = rows.withColumn("_plain", F.expr(f"{SEGMENTS} - _other % {SEGMENTS}"))
    rows = rows.withColumn(
        "_start", F.expr("_base * (_number - 1) + greatest(_number - 1 - _plain, 0) + 1 + _shift")
    ).withColumn("_size", F.expr("_base + if(_number > _plain, 1, 0)"))
    rows = rows.where("_start >= 1 and _start + _size - 1 <= _length")
    key = F.expr("xxhash64(_number, _other, substring(_code, 4 * _start - 3, 4 * _size))")
    return rows.select(F.col("_id").alias(name), key.alias("_key"))


def letters(text: str) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def within(left: str, right: str, edits: int = MAX_EDITS) -> Column:
    """Whether two columns of letters are within ``edits`` edits (insert, delete, replace one).

    Bit d of word e says that the left text up to d - ``edits`` past the place and the right
    text up to it are at most e edits apart. Each letter of the right text updates all words,
    and in them the whole band at once. The columns must be stored ones: an expression would be
    evaluated for each letter.
    """
    width = 2 * edits + 1
    band = (1 << width) - 1

    def equal(letter: Column, at: Column) -> Column:
        bits = [F.when(F.get(left, at + (bit - edits)) == letter, 1 << bit).otherwise(0) for bit in range(width)]
        return reduce(Column.bitwiseOR, bits)

    def step(state: Column, mask: Column) -> Column:
        words: list[Column] = []
        for e in range(edits + 1):
            word = state[f"w{e}"].bitwiseAND(mask)
            if e:
                before = state[f"w{e - 1}"]
                word = word.bitwiseOR(before).bitwiseOR(F.shiftright(before, 1))
                word = word.bitwiseOR(F.shiftleft(words[-1], 1).bitwiseAND(F.lit(band)))
            words.append(word)
        return _words(words)

    # With nothing read of the right text, dropping d letters of the left takes d edits.
    first = [F.lit(sum(1 << (d + edits) for d in range(e + 1))) for e in range(edits + 1)]
    last = F.aggregate(F.transform(right, equal), _words(first), step)[f"w{edits}"]
    difference = F.size(left) - F.size(right)
    wanted = F.element_at(F.array(*[F.lit(1 << bit) for bit in range(width)]), difference + edits + 1)
    return F.when(F.abs(difference) <= edits, last.bitwiseAND(wanted) > 0).otherwise(False)


def _words(words: list[Column]) -> Column:
    return F.struct(*[word.alias(f"w{e}") for e, word in enumerate(words)])


def sketch(text: Column) -> Column:
    """The counts of some letters, at most 255 of each, as bytes of a number."""
    counted = F.lit(0).cast("bigint")
    for place, letter in enumerate(SKETCHED):
        count = F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))
        counted = counted.bitwiseOR(F.shiftleft(F.least(count, F.lit(255)).cast("bigint"), 8 * place))
    return counted


def _possible(left: Column, right: Column) -> Column:
    """An edit changes the counts by two at most."""
    apart = F.lit(0)
    for place in range(len(SKETCHED)):
        one, other = (F.shiftrightunsigned(x, 8 * place).bitwiseAND(F.lit(255)) for x in (left, right))
        apart = apart + F.abs(one - other)
    return apart <= 2 * MAX_EDITS


def _parities(run: int) -> dict[str, Column]:
    """Of each class of runs of so many letters, whether the line (``_length``, stored ``_code`` in
    UTF-32) has an odd number of them, as bits of words. The last runs are shorter."""
    kind = f"pmod(xxhash64(substring(_code, 4 * at - 3, 4 * {run})), {64 * RUNS[run]})"
    found = {}
    for word in range(RUNS[run]):
        bit = f"if({kind} div 64 = {word}, shiftleft(1L, int({kind} % 64)), 0L)"
        odd = F.expr(f"aggregate(sequence(1, _length), 0L, (bits, at) -> bits ^ {bit})")
        found[f"_{run}_{word}"] = odd
    return found


def parities() -> dict[str, Column]:
    return {name: odd for run in RUNS for name, odd in _parities(run).items()}


def _same_runs(left: str, right: str) -> Column:
    """An edit takes as many runs as they are long at most, and adds as many."""
    few = F.lit(True)
    for run, words in RUNS.items():
        pairs = [[F.col(f"{side}_{run}_{word}") for side in (left, right)] for word in range(words)]
        apart = reduce(Column.__add__, [F.bit_count(one.bitwiseXOR(other)) for one, other in pairs])
        few = few & (apart <= 2 * run * MAX_EDITS)
    return few


def occurrences(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank: the document, the line's number from 0, the text
    without blanks at its ends, and two hashes of it."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("_text"),
        F.posexplode(F.split("text", "\n")).alias("line_no", "_line"),
    )
    rows = rows.withColumn("_line", F.trim("_line")).where("_line <> ''")
    return rows.withColumn("_h1", F.xxhash64("_line")).withColumn(
        "_h2", F.xxhash64(F.lit(1), F.col("_line"))
    )


def _dropped(longer: int | None) -> list[tuple[int, int, int, int]]:
    """(first, last, shift, longer): which two pieces of the shorter line may be edited, or one
    twice, by how much the first of them is longer in the other line, and that line as a whole."""
    found = []
    for first in range(1, PIECES + 1):
        found.append((first, first, longer or 0, longer or 0))
        for last in range(first + 1, PIECES + 1):
            # One edit each.
            shifts = [0] if longer is None else [s for s in (-1, 0, 1) if abs(longer - s) <= 1]
            found += [(first, last, shift, longer or 0) for shift in shifts]
    return found


def _left_over(lines: DataFrame, dropped: list[tuple[int, int, int, int]], name: str) -> DataFrame:
    """Ids of the lines, under that name, with the hash of what is left of a line without two
    pieces, and a checksum of each of these that has the length of the shorter line's piece.

    A CRC of 32 bits differs for certain if one letter, of 32 bits, does.
    """
    listed = F.array(*[F.struct(*map(F.lit, places)) for places in dropped])
    runs = list(parities())
    rows = lines.select("_id", "_length", "_sketch", "_code", *runs)
    rows = rows.select("*", F.inline(listed).alias("_first", "_last", "_shift", "_longer"))
    rows = rows.withColumn("_short", F.expr("_length - _longer")).where(F.col("_short") >= MIN_CHARS)
    rows = rows.withColumn("_base", F.expr(f"int(_short div {PIECES})"))
    rows = rows.withColumn("_plain", F.expr(f"{PIECES} - _short % {PIECES}"))

    def start(piece: str) -> str:
        return f"(_base * ({piece} - 1) + greatest({piece} - 1 - _plain, 0))"

    def part(begin: str, end: str) -> str:
        return f"substring(_code, 4 * ({begin}) + 1, 4 * (({end}) - ({begin})))"

    ends = {
        "_a": start("_first"),
        "_b": f"{start('_first + 1')} + _shift",
        "_c": f"if(_first = _last, {start('_first + 1')} + _shift, {start('_last')} + _shift)",
        "_d": f"{start('_last + 1')} + _longer",
    }
    rows = rows.withColumns({end: F.expr(place) for end, place in ends.items()})
    left = f"{part('0', '_a')}, {part('_b', '_c')}, {part('_d', '_length')}"
    two = "_first < _last and "
    return rows.select(
        F.col("_id").alias(name),
        F.expr(f"xxhash64(_first, _last, _short, {left})").alias("_key"),
        F.expr(f"if({two} _shift = 0, crc32({part('_a', '_b')}), null)").alias(f"{name}_first"),
        F.expr(f"if({two} _shift = _longer, crc32({part('_c', '_d')}), null)").alias(f"{name}_last"),
        F.col("_sketch").alias(f"{name}_sketch"),
        F.col("_longer").alias(f"{name}_longer"),
        *[F.col(run).alias(f"{name}{run}") for run in runs],
    )


def crowd_pairs(lines: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of ids among which are all near duplicates of these lines.

    Two edits lie in one piece of ``PIECES`` or in two, and the rest of the line is as it was, up
    to a shift between them. So lines meet that agree in all but two pieces, and not all that
    have a third of the line in common. A pair that differs in one piece only meets there alone:
    for two, both must differ. Sketches are compared in the join, and so are the parities of runs
    of letters: lines that agree in all but two pieces differ in few letters, but near copies
    changed by more than two edits mostly in more runs than two edits can change.
    """
    lines = written(lines.withColumn("_code", F.encode("_line", "UTF-32")).drop("_line"), "codes")
    lines = written(lines.withColumns(parities()), "crowd")
    index = _left_over(lines, _dropped(None), "_id")
    probe = _left_over(lines, [places for n in range(MAX_EDITS + 1) for places in _dropped(n)], "_other")
    once = (F.col("_other_longer") > 0) | (F.col("_id") < F.col("_other"))
    differ = [
        F.coalesce(F.col(f"_id{side}") != F.col(f"_other{side}"), F.lit(True)) for side in ("_first", "_last")
    ]
    possible = _possible(F.col("_id_sketch"), F.col("_other_sketch"))
    met = index.withColumnRenamed("_key", "_left").join(
        probe, (F.col("_left") == F.col("_key")) & once & differ[0] & differ[1] & possible & _same_runs("_id", "_other")
    )
    return met.select(F.least("_id", "_other").alias("a"), F.greatest("_id", "_other").alias("b"))


def candidates(lines: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of ids of lines among which are all near duplicates."""
    index = _keyed(lines, [(0, i, 0) for i in range(1, SEGMENTS + 1)], "_id")
    probe = _keyed(lines, probes(), "_other")
    # Of a crowd one row stays, which tells the lines that meet it.
    same = Window.partitionBy("_key")
    index = index.withColumns({"_many": F.count("*").over(same), "_one": F.min("_id").over(same)})
    crowd = F.col("_many") > CROWD
    index = index.where(~crowd | (F.col("_id") == F.col("_one")))
    met = index.join(probe, "_key").where(crowd | (F.col("_id") != F.col("_other")))
    met = written(met.select(F.when(~crowd, F.col("_id")).alias("_id"), "_other"), "met")
    pairs = met.where("_id is not null")
    pairs = pairs.select(F.least("_id", "_other").alias("a"), F.greatest("_id", "_other").alias("b"))
    crowded = written(met.where("_id is null").select(F.col("_other").alias("_id")).distinct(), "crowded")
    if not crowded.isEmpty():
        pairs = pairs.union(crowd_pairs(lines.join(crowded, "_id", "left_semi")))
    return pairs.distinct()


def links(lines: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of ids of the distinct lines (_id, _line, _length, _sketch) that are
    near duplicates."""
    met = candidates(lines)
    left, right = (
        lines.select(F.col("_id").alias(side), F.col("_sketch").alias(f"_{side}")) for side in ("a", "b")
    )
    met = met.join(left, "a").join(right, "b").where(_possible(F.col("_a"), F.col("_b")))
    met = written(met.select("a", "b"), "candidates")
    ids = written(met.select(F.col("a").alias("_id")).union(met.select("b")).distinct(), "ids")
    texts = lines.join(ids, "_id", "left_semi").select("_id", letters("_line").alias("_letters"))
    texts = written(texts, "letters")
    left, right = (
        texts.select(F.col("_id").alias(side), F.col("_letters").alias(f"_{side}")) for side in ("a", "b")
    )
    return met.join(left, "a").join(right, "b").where(within("_a", "_b")).select("a", "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank: doc_id, line_no, n_links, class_doc_id,
    class_line_no and kept.

    Lines are split at \\n and compared without blanks at their ends. ``n_links`` counts the
    other texts within two edits, if both have at least 30 code points; the class are all lines
    reachable by such links and by equality. Its first occurrence by doc_id (null first), line
    number and hash of the whole text names the class and is kept. Equal rows of a document
    share their verdict. Null and empty texts have no lines; other columns are ignored.
    """
    found = _classified(docs)
    return found.select("doc_id", "line_no", "n_links", "class_doc_id", "class_line_no", "kept")


def _classified(docs: DataFrame) -> DataFrame:
    lines = occurrences(docs).groupBy("_h1", "_h2", "_line").agg(F.count("*").alias("_copies"))
    lines = lines.withColumn("_id", F.monotonically_increasing_id())
    lines = lines.withColumn("_length", F.length("_line"))
    lines = written(lines.withColumn("_sketch", sketch(F.col("_line"))), "lines")
    pairs = written(links(lines.where(F.col("_length") >= MIN_CHARS)), "links")
    counts = pairs.select(F.col("a").alias("_id")).union(pairs.select("b")).groupBy("_id").agg(
        F.count("*").alias("n_links")
    )
    reached = components(pairs).select(F.col("node").alias("_id"), "component")
    named = counts.join(reached, "_id")
    named = lines.select("_id", "_h1", "_h2").join(named, "_id", "left").select(
        "_h1",
        "_h2",
        F.coalesce("component", "_id").alias("_class"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )
    places = occurrences(docs).drop("_line").join(named, ["_h1", "_h2"])
    places = written(places.drop("_h1", "_h2"), "places")
    first = places.groupBy("_class").agg(F.min(F.struct("doc_id", "line_no", "_text")).alias("_first"))
    both = places.join(first, "_class")
    here = F.struct("doc_id", "line_no", "_text")
    return both.select(
        "doc_id",
        "line_no",
        "_text",
        "n_links",
        F.col("_first.doc_id").alias("class_doc_id"),
        F.col("_first.line_no").alias("class_line_no"),
        here.eqNullSafe(F.col("_first")).alias("kept"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that ``near_duplicates`` doesn't keep taken out of the text."""
    found = _classified(docs).where("not kept")
    dropped = found.groupBy("doc_id", "_text").agg(F.collect_set("line_no").alias("_dropped"))
    dropped = written(dropped, "dropped")
    same = docs["doc_id"].cast("bigint").eqNullSafe(dropped["doc_id"])
    joined = docs.join(dropped, same & (F.xxhash64(docs["text"]) == dropped["_text"]), "left")
    lines, numbers = F.split(docs["text"], "\n"), dropped["_dropped"]
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(numbers, i)), "\n")
    text = F.when(numbers.isNull(), docs["text"]).otherwise(kept)
    return joined.select(*[text.alias(c) if c == "text" else docs[c] for c in docs.columns])
