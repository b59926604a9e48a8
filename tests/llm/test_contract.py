"""Registered queries, the pipeline, and the contracts that SQL does not check."""

from __future__ import annotations

import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import check
import corpus_pipeline
from medallion.llm import queries
from medallion.llm.common import table
from tests.llm.brute import components_of, fingerprint, link_fingerprints, shingles_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in table(spark, SF, "documents").collect()}


def test_one_query_for_each_operator():
    numbers = [name.partition("_")[0] for name in queries.QUERIES]
    assert numbers == [f"op{n}" for n in range(1, 14)]
    assert set(contract.queries()) >= {*queries.QUERIES, "pipeline"}


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_agrees_with_its_sql(spark, name):
    for sf in (SF, "/root/testdata/sf0.01"):
        df = queries.QUERIES[name](spark, sf)
        result = check.duck(sf).execute(queries.ORACLES[name])
        columns = [d[0] for d in result.description]
        assert sorted(df.columns) == sorted(columns)
        assert check.rows_of(df.columns, df.collect()) == check.rows_of(columns, result.fetchall())


def test_language_by_held_out_documents(spark, documents):
    rows = queries.QUERIES["op2_language_id"](spark, "/root/testdata/sf0.01").collect()
    given = {r["doc_id"]: r["lang"] for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 200
    assert sum(r["lang_pred"] == given[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_simhash_against_all_pairs(spark, documents):
    rows = queries.QUERIES["op3_simhash_near_dedup"](spark, SF).collect()
    want = {i: fingerprint(r["text"]) for i, r in documents.items()}
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in rows} == want
    assert {r["doc_id"]: r["component_id"] for r in rows} == components_of(want, link_fingerprints(want))


def test_decontamination_against_all_shingles(spark, documents):
    rows = queries.QUERIES["op8_benchmark_decontamination"](spark, SF).collect()
    want = set()
    for item in table(spark, SF, "benchmark").collect():
        sought = shingles_of(item["text"])
        for i, r in documents.items():
            shared = len(sought & shingles_of(r["text"]))
            if shared >= 0.8 * len(sought):
                want.add((i, item["item_id"], shared, len(sought)))
    assert {(r["doc_id"], r["item_id"], r["shared"], r["shingles"]) for r in rows} == want
    assert len(rows) == len(want) > 0


def test_tokens_against_whole_texts(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = {r["doc_id"]: r for r in queries.QUERIES["op10_token_blocks"](spark, SF).collect()}
    at = 0
    for i in sorted(documents):
        ids = tokenizer.encode(documents[i]["text"] or "", add_special_tokens=False).ids + [1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(rows[i])[1:] == (at, len(ids), crc)
        at += len(ids)


def test_packing_against_whole_texts(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = queries.QUERIES["op13_pattern_packing"](spark, SF).collect()
    want, total = set(), 0
    for i, r in documents.items():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want.add((i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {tuple(r)[:5] for r in rows} == want
    assert len(rows) == len(want)
    held = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == held.get(r["sequence_id"], 0)
        held[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(held.values()) <= 2048
    assert len(held) <= -(-total // 2048) + 1


def test_pipeline_against_its_stages_by_hand(spark, documents):
    rows = corpus_pipeline.run(spark, SF).collect()
    kept = {i: r["text"] for i, r in documents.items() if any(c.isalpha() for c in r["text"] or "")}
    prints = {i: fingerprint(t) for i, t in kept.items()}
    groups = components_of(prints, link_fingerprints(prints))
    items = [shingles_of(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    clean = {}
    for i in sorted(set(groups.values())):
        own = shingles_of(kept[i])
        if not any(len(item & own) >= 0.8 * len(item) for item in items):
            clean[i] = kept[i]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    connection.executemany(
        "INSERT INTO documents VALUES (?, ?, ?)", [(i, t, documents[i]["source"]) for i, t in clean.items()]
    )
    result = connection.execute(queries.ORACLES["op7_source_mixing"])
    names = [d[0] for d in result.description]
    mixed = [dict(zip(names, row, strict=True)) for row in result.fetchall()]
    copies = Counter({r["doc_id"]: r["taken"] // r["size"] for r in mixed if r["size"]})
    assert Counter(r["doc_id"] for r in rows if copies[r["doc_id"]]) == +copies
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    starts = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == starts
        assert r["n_tokens"] == len(tokenizer.encode(clean[r["doc_id"]], add_special_tokens=False).ids) + 1
        starts += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])] == sorted(r["doc_id"] for r in rows)


def test_stages_return_the_columns_of_documents(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
