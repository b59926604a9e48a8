"""Importance resampling: features, gains, radix ranks, odd rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion.llm import resampling
from medallion.llm.common import written
from medallion.llm.counting import digits, field
from tests.conftest import tuples

DOCS = "doc_id long, text string"


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_buckets(text, buckets=10_000):
    words = plain_words(text)
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return [zlib.crc32(run.encode()) % buckets for run in runs]


def brute(docs, target, percent=25, min_words=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(plain_buckets(text))
    for text in target:
        t.update(plain_buckets(text))
    every, wanted = s.total(), t.total()
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (every + 10000) / ((s[b] + 1) * (wanted + 10000))))
        for b in range(10_000)
    ]
    rows = []
    for doc_id, text in docs:
        found = plain_buckets(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score, len(plain_words(text)) >= min_words))
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    many = percent * len(fit) // 100
    ranked = [(*r[:4], place + 1 if place < many else None) for place, r in enumerate(fit)]
    return sorted([*ranked, *((*r[:4], None) for r in rows if not r[4])], key=repr)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aZ9 é中.\n0x"), max_size=200)), max_size=6))
def test_features_are_those_of_plain_text(texts):
    row, bucket, words = resampling.features(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert Counter(bucket[row == i].tolist()) == Counter(plain_buckets(text))
        assert words[i] == len(plain_words(text))


def test_features_of_a_slice_and_of_long_words():
    long = "b" * 100_000 + " c " + "é" * 500
    texts = pa.array(["skip", "a", long, None, ""], pa.string()).slice(1)
    row, bucket, words = resampling.features(texts)
    assert words.tolist() == [1, 3, 0, 0]
    assert Counter(bucket[row == 1].tolist()) == Counter(plain_buckets(long))


def corpus(n):
    pool = "alpha beta gamma delta epsilon zeta eta theta".split()
    return [(i, " ".join(pool[(i * j * 7 + j * j) % (3 + i % 6)] for j in range(10 + i % 40))) for i in range(n)]


def test_against_brute_force(spark):
    docs, target = corpus(300), ["alpha beta gamma", "Alpha, delta", None]
    df = spark.createDataFrame(docs, DOCS).repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    assert tuples(resampling.resample(df, wanted)) == brute(docs, target)


def test_odd_rows(spark):
    long = " ".join(["omega"] * 30_000)
    docs = [
        (None, "w " * 30), (None, None), (5, ""), (5, "..."), (7, "same " * 25), (7, "same " * 25),
        (-(1 << 63), "low " * 22), ((1 << 63) - 1, "high " * 22), (9, long), (9, "other " * 40),
    ]
    df = spark.createDataFrame(docs, DOCS).withColumns({"rank": F.lit("x"), "_place": F.lit(1), "score": F.lit(2)})
    target = spark.createDataFrame([("omega w",)], "text string")
    got = tuples(resampling.resample(df, target, percent=80))
    assert got == brute(docs, ["omega w"], percent=80)
    assert got == tuples(resampling.resample(df.repartition(7), target, percent=80))


def test_no_documents_and_no_target(spark):
    none = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame(corpus(40), DOCS)
    assert resampling.resample(none, some).collect() == []
    assert tuples(resampling.resample(some, none)) == brute(corpus(40), [])
    short = spark.createDataFrame([(1, "two words")], DOCS)
    assert [r["rank"] for r in resampling.resample(short, some).collect()] == [None]


def test_drawn_documents(spark):
    docs = spark.createDataFrame(corpus(80), DOCS).withColumn("rank", F.lit("own"))
    target = spark.createDataFrame([("alpha",)], "text string")
    ranks = {r["doc_id"]: r["rank"] for r in resampling.resample(docs, target).collect() if r["rank"]}
    rows = resampling.drawn(docs, target).collect()
    assert {r["doc_id"]: r["_rank"] for r in rows} == ranks
    assert all(r["text"] == dict(corpus(80))[r["doc_id"]] and r["rank"] == "own" for r in rows)


def test_radix_ranks_of_a_hot_digit(spark):
    """A third of all rows agree in the high field; the order is that of a plain sort."""
    n = 150_000
    rows = spark.range(0, n, 1, 7).select(
        F.when(F.col("id") % 3 == 0, 11).otherwise(F.xxhash64("id") % 1000).alias("a"),
        F.xxhash64(F.col("id") + 1).alias("b"),
    )
    stored = written(rows.withColumn("_place", F.monotonically_increasing_id()), "rows")
    ends = stored.agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    fields = [field(F.col("a"), ends[0], ends[1]), field(F.col("b"), ends[2], ends[3])]
    got = resampling.ranked(stored, fields).toPandas().sort_values("_place")
    assert got["_place"].tolist() == list(range(n))
    order = np.lexsort((got["b"], got["a"]))
    assert (order == np.arange(n)).all()


def test_digits_hold_bits_of_several_fields(spark):
    df = spark.createDataFrame([(5, 300), (2, 17)], "a long, b long")
    cut = digits([(F.col("a"), 3), (F.col("b"), 9)], 5)
    rows = df.select(*[d.alias(f"d{i}") for i, d in enumerate(cut)]).collect()
    assert [sum(d << (5 * i) for i, d in enumerate(r)) for r in rows] == [(5 << 9) + 300, (2 << 9) + 17]
