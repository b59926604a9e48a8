from __future__ import annotations

import pathlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.readwriter import DataFrameWriter

from medallion.llm import embedding_dedup
from medallion.llm.queries import QUERIES
from tests.llm.brute import components_of

SCHEMA = "vec_id bigint, embedding array<float>, label int, _node string, n_links string"


def near_by_hand(rows):
    """(n_links, component) of rows (id, vector, label), all usable and with ids of their own."""
    units = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v, _ in rows}
    labels = {i: label for i, _, label in rows}
    ids = [i for i, _, _ in rows]
    edges = [
        (a, b)
        for n, a in enumerate(ids)
        for b in ids[n + 1 :]
        if labels[a] == labels[b] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.98
    ]
    counts = {i: 0 for i in ids}
    for a, b in edges:
        counts[a] += 1
        counts[b] += 1
    found = components_of(ids, edges)
    return {i: (counts[i], found[i]) for i in ids}


def collected(vectors):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(vectors).collect()}


@pytest.mark.parametrize("cell,block", [(2048, 2048), (40, 30)])
def test_against_all_pairs(spark, monkeypatch, cell, block):
    monkeypatch.setattr(embedding_dedup, "CELL", cell)
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    draw = np.random.default_rng(1)
    rows = []
    for label in range(3):
        centres = draw.normal(size=(25, 8))
        for n in range(200):
            # Chains, copies, scaled copies and tight groups around few centres.
            vector = centres[n % 25] + draw.normal(size=8) * draw.choice([0.0, 0.05, 0.1, 0.2])
            rows.append((1000 * label + n, [float(x) for x in np.float32(vector * draw.choice([1, 1, 4]))], label))
    vectors = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    want = near_by_hand(rows)
    assert sum(n for n, _ in want.values()) > 1000
    assert collected(vectors) == want


def held(spark):
    """Bytes of the files in the shared folder and in Spark's own."""
    sc = spark.sparkContext
    tops = [spark.conf.get("spark.checkpoint.dir"), *sc._jsc.sc().env().blockManager().diskBlockManager().localDirsString()]
    return sum(p.stat().st_size for top in tops for p in pathlib.Path(top).rglob("*") if p.is_file())


def test_scratch_of_many_cells_stays_near_the_size_of_the_vectors(spark, monkeypatch):
    """Random vectors are guests in most cells: shipping them at once takes the disk of so many copies."""
    for name, value in (("CELL", 1000), ("BLOCK", 600), ("ROUND", 1 << 10)):
        monkeypatch.setattr(embedding_dedup, name, value, raising=False)
    draw = np.random.default_rng(7)
    vectors = draw.normal(size=(8000, 64))
    vectors[4000:4500] = vectors[:500] + draw.normal(size=(500, 64)) * 0.1
    vectors[5000:5300] = vectors[-1] + draw.normal(size=(300, 64)) * 0.08
    vectors = np.float32(vectors)
    rows = pa.table({"vec_id": range(8000), "embedding": list(vectors), "label": pa.array(np.zeros(8000, np.int32))})
    before, most = held(spark), []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (write(self, *a, **b), most.append(held(spark)))[0])
    found = collected(spark.createDataFrame(rows))
    units = vectors / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    near = units @ units.T >= 0.98
    links = near.sum(axis=1) - 1
    assert [found[n][0] for n in range(8000)] == links.tolist()
    edges = [(a, b) for a, b in zip(*np.nonzero(near), strict=True) if a < b]
    assert {n: c for n, (_, c) in found.items()} == components_of(range(8000), edges)
    assert (links > 0).sum() > 1000 and (links > 100).sum() > 100
    assert max(most) - before < 4 * vectors.nbytes


@pytest.mark.parametrize("dim,noise", [(3, 0.02), (40, 0.01), (40, 0.022), (800, 0.004)])
def test_block_and_guests_against_all_pairs(monkeypatch, dim, noise):
    for name, value in (("INNER", 10), ("PIECE", 16), ("CHUNK", 50), ("WIDEST", 16_000)):
        monkeypatch.setattr(embedding_dedup, name, value)
    draw = np.random.default_rng(dim)
    centres = draw.normal(size=(30, dim))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    vectors = centres[draw.integers(0, 30, 500) ** 2 // 30] + draw.normal(size=(500, dim)) * noise
    vectors *= draw.choice([1, 5], 500)[:, None]
    nodes, copies = draw.permutation(5000)[:500], draw.integers(1, 4, 500)
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    near = units @ units.T >= 0.98
    np.fill_diagonal(near, False)
    block = embedding_dedup.Block(nodes[:300], copies[:300], vectors[:300])
    block.meet_itself()
    parts = [block.meet(nodes[a : a + 50], copies[a : a + 50], vectors[a : a + 50]) for a in range(300, 500, 50)]
    parts.append(block.found())
    rows = [tuple(r.values()) for part in parts for r in part.to_pylist()]
    near[300:, 300:] = False
    want = near @ copies
    assert {node: n for node, n, _ in rows} == {n: c for n, c in zip(nodes.tolist(), want.tolist(), strict=True) if c}
    ids = nodes[want > 0].tolist()
    edges = [(nodes[a], nodes[b]) for a, b in zip(*np.nonzero(near), strict=True)]
    assert len(edges) > 1000
    assert components_of(ids, [(a, b) for a, _, b in rows if b is not None]) == components_of(ids, edges)


def test_every_pair_within_reach_meets_once_and_rounds_are_bounded(monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    draw = np.random.default_rng(3)
    units = embedding_dedup._unit(draw.normal(size=(600, 4)))
    centres = units[:8]
    _, cells, own = embedding_dedup.cells_of(units, centres)
    home, guests = (np.bincount(cells[x], minlength=8) for x in (own, ~own))
    plan = embedding_dedup.Plan({(1, 4): centres}, [(1, 4, c, int(home[c]), int(guests[c])) for c in range(8)], 4 * 600)
    rows, to, at_home = plan.places((1, 4), units, np.arange(600))
    assert at_home.sum() == 600 and len(plan.turns) > 12
    shipped = np.bincount(plan.turns[to])
    assert len(plan.rounds) > 2 and shipped.max() < 2 * 600
    mine = dict(zip(rows[at_home].tolist(), to[at_home].tolist(), strict=True))
    there = {(r, b) for r, b in zip(rows.tolist(), to.tolist(), strict=True)}
    assert len(there) == len(rows)
    for a, b in zip(*np.nonzero(np.triu(units @ units.T >= 0.98, 1)), strict=True):
        assert mine[a] == mine[b] or ((a, mine[b]) in there) + ((b, mine[a]) in there) == 1


def test_doubles_whose_squares_leave_their_range(spark):
    schema = "vec_id bigint, embedding array<double>, label int"
    rows = [(1, [1e-200, 0.0], 0), (2, [1e200, 1e190], 0), (3, [0.0, 1e-200], 0), (4, [1.0, 0.0], 0), (5, [-0.0, 2.0], 0), (6, [0.0, 2.0], 0)]
    found = collected(spark.createDataFrame(rows, schema))
    assert found == {1: (2, 1), 2: (2, 1), 4: (2, 1), 3: (2, 3), 5: (2, 3), 6: (2, 3)}


def test_rows_of_one_id_with_different_vectors(spark):
    rows = [(1, [1.0, 0.0, 0.0], 0), (1, [0.0, 1.0, 0.0], 0), (2, [1.0, 0.01, 0.0], 0),
            (3, [0.01, 1.0, 0.0], 0), (4, [0.0, 1.0, 0.01], 0), (9, [0.0, 0.0, 1.0], 0), (8, [0.01, 0.0, 1.0], 0)]
    vectors = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    found = sorted(tuple(r) for r in embedding_dedup.near_duplicates(vectors).collect())
    assert found == [
        (1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (4, 2, 1, False),
        (8, 1, 8, True), (9, 1, 8, False),
    ]


def test_given_vectors_and_near_copies_of_them_against_sql(spark):
    """The given vectors have no links; copies with a little noise have, also under shared ids."""
    given = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    draw, rows = np.random.default_rng(4), []
    for r in given:
        rows.append((r["vec_id"], r["embedding"], r["label"]))
        for n in range(draw.integers(0, 4)):
            noise = draw.normal(size=64) * draw.choice([0.0, 0.01, 0.03])
            vector = [float(x) for x in np.float32(np.array(r["embedding"]) + noise)]
            rows.append((r["vec_id"] % 97 if n == 2 else 10_000 * (n + 1) + r["vec_id"], vector, r["label"]))
    vectors = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    connection = duckdb.connect()
    connection.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    connection.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    want = sorted(connection.execute(embedding_dedup.ORACLE).fetchall())
    found = embedding_dedup.near_duplicates(vectors)
    assert sorted(tuple(r) for r in found.select("vec_id", "n_links", "component_id", "kept").collect()) == want
    assert sum(n > 0 for _, n, _, _ in want) > 500


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0, 0.0], [1.0, None], [1.0, nan], [inf, 1.0]]
    rows = [(i, v, 1) for i, v in enumerate(odd)]
    rows += [(10, [1.0, 0.0], 1), (11, [2.0, 0.0], 1), (12, [1.0, 0.0], 2), (13, [1.0, 0.0], None)]
    rows += [(14, [1.0, 0.0, 0.0], 1), (15, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (15, [1.0, 0.0], 1)]
    rows += [(20, [1e-30, 0.0], 3), (21, [1e30, 0.0], 3)]
    vectors = spark.createDataFrame([(*r, "x", "x") for r in rows], SCHEMA)
    found = [tuple(r) for r in embedding_dedup.near_duplicates(vectors).collect()]
    assert len(found) == len(rows)
    alone = {(i, 0, i, True) for i in (0, 1, 2, 3, 4, 5, 12, 13, 14)}
    assert alone <= set(found)
    assert (None, 0, None, False) in found
    assert (10, 3, 10, True) in found and (11, 3, 10, False) in found
    assert found.count((15, 3, 10, False)) == 2
    assert {(20, 1, 20, True), (21, 1, 20, False)} <= set(found)
    assert embedding_dedup.near_duplicates(vectors.limit(0)).count() == 0


def test_guests_reach_every_cell_they_may_link_into():
    draw = np.random.default_rng(2)
    units = embedding_dedup._unit(draw.normal(size=(400, 3)))
    rows, cells, home = embedding_dedup.cells_of(units, units[:20])
    members = [set(rows[cells == c]) for c in range(20)]
    own = dict(zip(rows[home].tolist(), cells[home].tolist(), strict=True))
    assert len(own) == 400 and len(rows) < 400 * 10
    for a, b in zip(*np.nonzero(units @ units.T >= 0.98), strict=True):
        assert b in members[own[a]]


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    found = QUERIES["op4_embedding_near_dedup"](spark, sf).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == near_by_hand([tuple(r) for r in rows])
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
