"""Lines of which very many have a segment in common."""

from __future__ import annotations

import random
import string

from pyspark.sql import functions as F

from medallion.llm import line_dedup
from tests.llm.test_lines import by_hand, changed, docs_of


def test_crowds_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "CROWD", 2)
    draw = random.Random(5)
    base = ["".join(draw.choices("abcde é😀h", k=n)).strip() for n in (31, 32, 40, 59, 60, 61)]
    base += ["ab" * 20, "a" * 45]
    rows = []
    for doc in range(50):
        rows.append((doc, "\n".join(changed(draw, draw.choice(base), draw.randrange(4)) for _ in range(8))))
    found = {tuple(r) for r in line_dedup.near_duplicates(docs_of(spark, rows)).collect()}
    assert found == by_hand(rows)


def test_few_of_many_near_copies_are_candidates(spark):
    draw = random.Random(6)
    line = "".join(draw.choices("etaoinsr xyzlmw", k=90))
    texts = set()
    while len(texts) < 400:
        at = draw.randrange(len(line))
        texts.add(line[:at] + "".join(draw.choices("bcdfghjkqv", k=3)) + line[at:])
    texts.add(line[:40] + "#" + line[40:])
    lines = spark.createDataFrame(list(enumerate(sorted(texts))), "_id bigint, _line string")
    lines = lines.withColumn("_length", F.length("_line")).withColumn("_sketch", line_dedup.sketch(F.col("_line")))
    found = line_dedup.candidates(lines).count()
    assert found < 0.35 * 400 * 399 / 2


def test_parities_of_runs_rule_out_no_pair_within_reach(spark):
    draw = random.Random(9)
    pairs = []
    for _ in range(500):
        a = "".join(draw.choices("etaoinsr xyé😀", k=draw.randrange(30, 400)))
        pairs.append((a, changed(draw, a, 2), changed(draw, a[:20] + "bcdf" + a[20:] + "ghjk", 2)))
    pairs += [(a * 32, a * 33, a * 40 + b * 40) for a, b in ("xy", "ab", "é😀")]
    df = spark.createDataFrame(pairs, "x string, y string, z string")
    sides = []
    for side in "xyz":
        rows = df.select("x", F.length(side).alias("_length"), F.encode(side, "UTF-32").alias("_code"))
        rows = rows.localCheckpoint().select("x", *[odd.alias(side + name) for name, odd in line_dedup.parities().items()])
        sides.append(rows.withColumnRenamed("x", side + "x"))
    one, other, far = sides
    near = one.join(other, F.col("xx") == F.col("yx")).join(far, F.col("xx") == F.col("zx"))
    near = near.select(line_dedup._same_runs("x", "y").alias("near"), line_dedup._same_runs("x", "z").alias("far"))
    found = near.collect()
    assert all(r["near"] for r in found)
    assert sum(r["far"] for r in found) < 10


def near_copies(spark, count):
    """One line in which four letters are put in, elsewhere each time, and two pairs of links."""
    draw = random.Random(7)
    line = "".join(draw.choices("etaoinsr xyzlmw", k=200))
    texts = {line + "0", line + "1", "#" + line[1:100] + line[101:], "#" + line[1:]}
    while len(texts) < count:
        at = draw.randrange(len(line))
        texts.add(line[:at] + "".join(draw.choices(string.ascii_lowercase, k=4)) + line[at:])
    lines = spark.createDataFrame(list(enumerate(sorted(texts))), "_id bigint, _line string")
    return lines.withColumn("_length", F.length("_line")).withColumn("_sketch", line_dedup.sketch(F.col("_line")))


def test_candidates_of_many_near_copies_are_about_their_links(spark):
    count = 600
    lines = near_copies(spark, count)
    ids = {r["_line"]: r["_id"] for r in lines.collect()}
    pairs = {(r["a"], r["b"]) for r in line_dedup.candidates(lines).collect()}
    assert len(pairs) < 0.02 * count * (count - 1) / 2
    line = next(text[:-1] for text in ids if text.endswith("0"))
    linked = [(line + "0", line + "1"), ("#" + line[1:100] + line[101:], "#" + line[1:])]
    assert {tuple(sorted(ids[text] for text in pair)) for pair in linked} <= pairs
