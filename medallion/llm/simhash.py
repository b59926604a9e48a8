"""SimHash near-duplicates by Golay-code fuzzy hashing.

A text's fingerprint has 64 bits, each the majority over the hashes of its word shingles.
To find fingerprints that differ in few bits, a fingerprint is cut into four segments of 16
bits, each read as a word of the perfect binary Golay code (23 bits, seven of them zero).
Around each word there are one or six code words within four bits, by whose 12-bit numbers
the segment is known. Two words that differ in at most two bits share one of them: the word
halfway has its own code word within three bits, so both have it within four. Of words that
differ in at most one bit, each has the nearest code word of the other in its list.

Four errors over four segments leave either

- a segment free of errors; of any two of the other three, one has at most two errors: the
  key is the exact segment with a number out of the list of the other (28 bits), or
- exactly one error in each segment: the key is three numbers (36 bits), out of the list of
  one side where the other side gives its nearest, in both ways.

No pair within four bits is missed, and every candidate is verified on all 64 bits. A task links
the fingerprints of one key after the other. It passes a key with more than ``HOT`` of them on:
these are cut into blocks by a hash, and each pair of blocks is a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import arrow_table, bounded_batches, slices, written
from medallion.llm.components import components

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
HASH_SEED = 42
BATCH_BYTES = 500_000
SEGMENT_BITS = 16
# Fingerprints of a key that a task links by itself, and those of a block of a larger key.
HOT, BLOCK = 32_768, 8_192
# Fixed values of the Golay code: 23 bits carry 12, by this generator polynomial.
CODE_BITS, DATA_BITS, GENERATOR = 23, 12, 0b101011100011
LIST_RADIUS = 4
# A run of more rows than this is searched from one member to the next.
SHORT_RUN = 24


# Fingerprints


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """The unsigned fingerprint of each text; zero for a text without words."""
    found = np.zeros(len(texts), np.uint64)
    hashes: list[int] = []
    owners, counts = [], []
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = np.concatenate(([0], blanks + 1))
        ends = np.concatenate((blanks, [len(joined)]))
        whole = min(SHINGLE_WORDS, len(words)) - 1
        spans = zip(starts[: len(starts) - whole].tolist(), ends[whole:].tolist(), strict=True)
        before = len(hashes)
        hashes += [digest(joined[a:b], HASH_SEED) for a, b in spans]
        owners.append(i)
        counts.append(len(hashes) - before)
    if owners:
        sizes = np.array(counts)
        found[owners] = _majority(np.array(hashes, np.uint64), sizes)
    return found


def _majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int64)
    majority = ones * 2 > sizes[:, None]
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = pa.schema([("doc_id", pa.int64()), ("_fp", pa.int64())])
    for batch in batches:
        for start, end in slices(batch.column("text"), BATCH_BYTES):
            part = batch.slice(start, end - start)
            found = fingerprints(part.column("text").to_pylist()).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], schema=out)


# Keys


@cache
def golay_lists() -> np.ndarray:
    """The numbers of the code words within four bits of each 16-bit word, nearest first, -1
    where there are fewer than six."""
    data = np.arange(1 << DATA_BITS, dtype=np.int64)
    words = np.zeros_like(data)
    for bit in range(DATA_BITS):
        words ^= np.where(data >> bit & 1, GENERATOR << bit, 0)
    lists = np.full((1 << SEGMENT_BITS, 6), -1, np.int64)
    for start in range(0, 1 << SEGMENT_BITS, 128):
        distance = np.bitwise_count(np.arange(start, start + 128)[:, None] ^ words)
        rows, numbers = np.nonzero(distance <= LIST_RADIUS)
        order = np.lexsort((distance[rows, numbers], rows))
        rows, numbers = rows[order], numbers[order]
        lists[start + rows, np.arange(len(rows)) - np.searchsorted(rows, rows)] = numbers
    return lists


def _packed(number: int, *fields: tuple[np.ndarray, int]) -> np.ndarray:
    key = np.int64(number)
    for values, bits in fields:
        key = key << np.int64(bits) | values
    return key


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of fingerprints, and for each key the row of its fingerprint."""
    lists = golay_lists()
    segments = [(fps >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    near = [lists[s] for s in segments]
    at = np.arange(len(fps))
    found, owners = [], []

    def add(key: np.ndarray, *used: np.ndarray) -> None:
        valid = np.all([u >= 0 for u in np.broadcast_arrays(key, *used)[1:]], axis=0)
        rows = np.broadcast_to(at.reshape(-1, *[1] * (key.ndim - 1)), key.shape)
        found.append(key[valid])
        owners.append(rows[valid])

    number = 0
    for exact in range(4):
        for other in [i for i in range(4) if i != exact][:2]:
            number += 1
            key = _packed(number, (segments[exact][:, None], 16), (near[other], 12))
            add(key, near[other])
    number += 1
    first, second, third = near[:3]
    key = _packed(number, (first[:, :1], 12), (second, 12), (third[:, :1], 12))
    add(key, second)
    left, right = first[:, :, None], third[:, None, :]
    key = _packed(number, (left, 12), (second[:, :1, None], 12), (right, 12))
    add(key, left, right)
    return np.concatenate(found), np.concatenate(owners)


KEYED = pa.schema([("_key", pa.int64()), ("_fp", pa.int64()), ("_node", pa.int64())])


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("_fp").to_numpy().view(np.uint64)
        nodes = batch.column("_node").to_numpy()
        for start in range(0, len(fps), 4_000):
            some = fps[start : start + 4_000]
            found, owners = keys(some)
            yield arrow_table(
                KEYED, found, some.view(np.int64)[owners], nodes[start : start + 4_000][owners]
            )


# Links


def links(
    fps: np.ndarray, nodes: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is linked within each run of rows; ``starts`` and ``ends`` have
    for each row the bounds of its run.

    Short runs compare each row with every later one. In a long run each row, when reached,
    takes what is near to it out of the rest, so that one member of a tight group meets all
    of it and the others nothing: the edges span the links without being all of them.
    """
    left, right = [nodes[:0]], [nodes[:0]]
    alive = np.flatnonzero(ends - starts <= SHORT_RUN)
    for lag in range(1, SHORT_RUN):
        alive = alive[alive + lag < ends[alive]]
        linked = alive[np.bitwise_count(fps[alive] ^ fps[alive + lag]) <= MAX_DISTANCE]
        left.append(nodes[linked])
        right.append(nodes[linked + lag])
    for start in np.unique(starts[ends - starts > SHORT_RUN]):
        rest = np.arange(start, ends[start])
        while len(rest):
            reached, rest = [rest[0]], rest[1:]
            while reached and len(rest):
                row = reached.pop()
                near = np.bitwise_count(fps[rest] ^ fps[row]) <= MAX_DISTANCE
                taken, rest = rest[near], rest[~near]
                left.append(np.full(len(taken), nodes[row]))
                right.append(nodes[taken])
                reached += taken.tolist()
    pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


LINKED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("_key", pa.int64())])


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) of rows that come sorted by key; a run may go on in the next batch. Those of
    a run that grows beyond ``HOT`` are passed on, as (fingerprint, node) with their key."""
    held, hot = np.zeros((3, 0), np.int64), None
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy() for i in range(3)])
        rows = np.concatenate([held, rows], axis=1) if held.shape[1] else rows
        if hot is not None and rows.shape[1]:
            end = int(np.searchsorted(rows[0], hot, side="right"))
            yield _passed_on(rows[:, :end])
            rows = rows[:, end:]
            hot = hot if not rows.shape[1] else None
        last = int(np.searchsorted(rows[0], rows[0, -1])) if rows.shape[1] else 0
        yield from _linked_runs(rows[:, :last])
        held = rows[:, last:]
        if held.shape[1] > HOT:
            hot = held[0, 0]
            yield _passed_on(held)
            held = held[:, :0]
    yield from _linked_runs(held)


def _passed_on(rows: np.ndarray) -> pa.RecordBatch:
    return arrow_table(LINKED, rows[1], rows[2], rows[0])


def _linked_runs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The same for rows of whole runs."""
    starts = np.searchsorted(rows[0], rows[0])
    ends = np.searchsorted(rows[0], rows[0], side="right")
    large = ends - starts > HOT
    if large.any():
        yield _passed_on(rows[:, large])
        rows = rows[:, ~large]
        starts = np.searchsorted(rows[0], rows[0])
        ends = np.searchsorted(rows[0], rows[0], side="right")
    if rows.shape[1]:
        a, b = links(rows[1].view(np.uint64), rows[2], starts, ends)
        yield arrow_table(LINKED, a, b, np.full(len(a), None))


EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _link_blocks(rows: pa.Table) -> pa.Table:
    """Edges of the fingerprints of two blocks, or of one, as of one run."""
    fps, nodes = (rows.column(c).to_numpy() for c in ("_fp", "_node"))
    size = len(fps)
    a, b = links(fps.view(np.uint64), nodes, np.zeros(size, np.int64), np.full(size, size))
    return pa.Table.from_batches([arrow_table(EDGES, a, b)])


def linked(keyed: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the nodes of (_key, _fp, _node) whose fingerprints share a key
    and are linked."""
    runs = keyed.repartition("_key").sortWithinPartitions("_key")
    found = written(runs.mapInArrow(_link_batches, "a bigint, b bigint, _key bigint"), "linked")
    edges = found.where("_key is null").select("a", "b")
    hot = found.where("_key is not null").select("_key", F.col("a").alias("_fp"), F.col("b").alias("_node"))
    sizes = hot.groupBy("_key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    blocks = hot.join(written(sizes, "sizes"), "_key")
    blocks = blocks.withColumn("_block", F.pmod(F.xxhash64("_fp"), F.col("_blocks")).cast("int"))
    blocks = blocks.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    pair = (F.least("_block", "_other").alias("_low"), F.greatest("_block", "_other").alias("_high"))
    pairs = blocks.select("_key", "_fp", "_node", *pair).groupBy("_key", "_low", "_high")
    return edges.unionByName(pairs.applyInArrow(_link_blocks, "a bigint, b bigint"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of each row of ``docs``.

    Rows whose fingerprints differ in at most four bits are linked; the component is the
    smallest doc_id reachable. Null and empty texts have fingerprint zero and are linked like
    any other. Rows without doc_id get their fingerprint, link nothing and have a null
    component; rows that share a doc_id join what is linked to either. Equal fingerprints are
    one node, so that groups of exact copies cost one row, and other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    prints = written(rows.mapInArrow(_fingerprint_batches, "doc_id bigint, _fp bigint"), "prints")
    nodes = written(prints.groupBy("_fp").agg(F.min("doc_id").alias("_node")), "nodes")
    found = nodes.where("_node is not null")
    keyed = found.mapInArrow(_key_batches, "_key bigint, _fp bigint, _node bigint")
    reached = components(linked(keyed)).select(F.col("node").alias("_node"), "component")
    reached = reached.groupBy("_node").agg(F.min("component").alias("component"))
    classes = nodes.join(reached, "_node", "left").select(
        "_fp", F.coalesce("component", "_node").alias("component_id")
    )
    named = F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint")
    joined = prints.join(written(classes, "classes"), "_fp")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return joined.select("doc_id", named, component)


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose document stands for its group: its doc_id is the
    component's.

    Of repeated rows of that id one stays: the one with the smallest text, nulls first. Rows
    without doc_id belong to no group and stay. The ids that stay are as many as the groups:
    they are merged with the documents, never broadcast.
    """
    standing = near_duplicates(docs).where("doc_id = component_id")
    standing = standing.groupBy(F.col("doc_id").alias("_kept")).agg(F.count("*").alias("_rows"))
    standing = written(standing, "standing")
    single = written(standing.where("_rows = 1"), "single")
    several = written(standing.where("_rows > 1"), "several")
    repeated = docs.join(several, docs["doc_id"] == several["_kept"], "left_semi")
    order = F.struct(repeated["text"], F.xxhash64(*repeated.columns))
    first = repeated.groupBy(repeated["doc_id"]).agg(
        F.min_by(F.struct(*repeated.columns), order).alias("_row")
    )
    return (
        docs.join(single.hint("merge"), docs["doc_id"] == single["_kept"], "left_semi")
        .unionByName(first.select("_row.*"))
        .unionByName(docs.where(F.col("doc_id").isNull()))
    )
