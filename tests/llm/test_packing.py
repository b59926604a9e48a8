"""Packing: patterns, counts, plan, places, files, odd rows."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from medallion.llm import packing
from tests.conftest import tuples

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string"


def counts_of(lengths, length):
    return np.bincount(lengths, minlength=length + 1)


def checked(counts):
    """The number of sequences of a plan that holds every piece once and nothing too long."""
    length, held = len(counts) - 1, np.zeros(len(counts), np.int64)
    groups = packing.plan(counts)
    for runs, many in groups:
        assert many > 0 and sum(n * each for n, each in runs) <= length
        for n, each in runs:
            held[n] += each * many
    assert (held == counts).all()
    return sum(many for _, many in groups)


def best(lengths, length):
    """The least number of sequences, by trying everything."""
    lengths = sorted(lengths, reverse=True)
    least = [len(lengths)]

    def place(i, bins):
        if len(bins) >= least[0]:
            return
        if i == len(lengths):
            least[0] = len(bins)
            return
        for j in {b: k for k, b in enumerate(bins)}.values():
            if bins[j] + lengths[i] <= length:
                place(i + 1, [b + lengths[i] * (k == j) for k, b in enumerate(bins)])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return least[0]


def test_patterns_are_all_that_fill_a_sequence():
    occur = {1, 2, 3, 5, 8, 11, 12}
    counts = counts_of(sorted(occur), 12)
    want = {
        (a, b, c)
        for a in occur for b in occur | {0} for c in occur | {0}
        if a >= b >= c and a + b + c == 12
    }
    got = [tuple(p) for p in packing.patterns(counts).tolist()]
    assert set(got) == want and len(got) == len(want)


def test_least_squares_meet_a_histogram_that_patterns_make():
    every = np.array([[10, 6, 0], [9, 7, 0], [8, 5, 3]])
    counts = counts_of([10, 6] * 40 + [9, 7] * 30 + [8, 5, 3] * 20, 16)
    assert np.allclose(packing.repeats(every, counts), [40, 30, 20], atol=1e-3)
    left = counts.copy()
    assert packing.rounded(np.array([40.2, 29.6, 25.0]), every, left).tolist() == [40, 30, 20]
    assert left.sum() == 0


@settings(deadline=None, max_examples=40)
@given(st.lists(st.integers(1, 24), max_size=60))
def test_plans_hold_every_piece_once(lengths):
    many = checked(counts_of(lengths, 24))
    assert many >= -(-sum(lengths) // 24)


@settings(deadline=None, max_examples=25)
@given(st.lists(st.integers(3, 20), min_size=1, max_size=9))
def test_plans_come_near_the_least(lengths):
    assert checked(counts_of(lengths, 24)) <= best(lengths, 24) + 1


@pytest.mark.parametrize("scale", [1, 1000, 10**7])
def test_plans_of_many_pieces_are_tight(scale):
    rng = np.random.default_rng(2)
    counts = counts_of(np.minimum(rng.geometric(1 / 90, 4000), 256), 256) * scale
    least = -(-int((counts * np.arange(257)).sum()) // 256)
    assert checked(counts) <= least * 1.001 + 1


def test_places_number_each_length_without_gap():
    counts = counts_of([7, 7, 7, 5, 5, 3, 2, 2, 2, 2, 1], 12)
    places = packing.Places(packing.plan(counts))
    spans = {}
    for n in np.flatnonzero(counts).tolist():
        sequence, offset = places.of(np.full(counts[n], n), np.arange(counts[n]))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            spans.setdefault(s, []).append((o, o + n))
    assert set(spans) == set(range(places.sequences))
    for held in spans.values():
        held.sort()
        assert [a for a, _ in held] == [0, *(b for _, b in held[:-1])]
        assert held[-1][1] <= 12


def test_wide_ids_take_four_bytes():
    compress, decompress = zstandard.ZstdCompressor().compress, zstandard.ZstdDecompressor().decompress
    for ids in ([1, 2, 65535], [1, 65536], []):
        data = packing._packed(compress, np.array(ids, "<u4"))
        assert packing.unpacked(decompress, data).tolist() == ids


def test_sequences_hold_the_texts(spark, folder):
    rows = [(i, f"word{i} " * (i * 7 % 50)) for i in range(200)] + [(900, "long text " * 300)]
    packing.pack(spark.createDataFrame(rows, DOCS).repartition(4), folder, PATH, length=64)
    tokenizer, decompress = Tokenizer.from_file(PATH), zstandard.ZstdDecompressor().decompress
    texts, stored = {}, packing.sequences(spark, folder).collect()
    assert len({r["sequence_id"] for r in stored}) == len(stored)
    for r in stored:
        ids, at = packing.unpacked(decompress, r["ids"]).tolist(), 0
        assert len(ids) <= 64
        for doc_id, start, n in zip(r["doc_ids"], r["starts"], r["lengths"], strict=True):
            texts.setdefault(doc_id, []).append((start, ids[at : at + n]))
            at += n
        assert at == len(ids)
    for doc_id, text in rows:
        whole = [i for _, part in sorted(texts[doc_id]) for i in part]
        assert whole == tokenizer.encode(text, add_special_tokens=False).ids + [0]
    total = sum(len(i) for parts in texts.values() for _, i in parts)
    assert len(stored) <= 1.02 * total / 64 + 1


def test_odd_rows(spark):
    rows = [(None, None), (None, "a"), (1, ""), (1, ""), (2, "same text"), (2, "same text"), (3, "x " * 5000)]
    df = spark.createDataFrame(rows, DOCS).withColumns(
        {"length": F.lit(1), "_place": F.lit("x"), "piece": F.lit(2), "sequence_id": F.lit(3)}
    )
    got = packing.packed(df, PATH)
    pieces = tuples(got, "doc_id", "piece", "start", "length")
    longest = [(3, i, i * 2048, min(2048, 5001 - i * 2048)) for i in range(3)]
    assert pieces == sorted(
        [(None, 0, 0, 1), (None, 0, 0, 2), *[(1, 0, 0, 1)] * 2, *[(2, 0, 0, 3)] * 2, *longest], key=repr
    )
    assert got.select("sequence_id").distinct().count() == 3


def test_no_documents(spark):
    assert packing.packed(spark.createDataFrame([], DOCS), PATH).collect() == []


def test_only_whole_pieces(spark):
    rows = [(1, "x " * 2047)]
    assert tuples(packing.packed(spark.createDataFrame(rows, DOCS), PATH), "length", "offset") == [(2048, 0)]
