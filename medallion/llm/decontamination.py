"""Benchmark decontamination: MinHash containment search for short items in long documents.

An item is contained in a document if the document has at least four fifths of its distinct
five-word shingles. An item of fewer words is one shingle, all its words. An item of n shingles
is sketched by its smallest shingle hashes, as many as may be missing and one more: a document
that contains the item lacks fewer, so it has at least one of them. The length of the sketch
follows from the item's size, not from the documents', so that nothing is missed however long a
document is, where the minima of a whole long document would almost never be those of a short
item.

Items are partitioned by size, each partition with an index of its own, and a document probes
the partitions whose items it has shingles enough to hold. Candidates are verified by the
shingles themselves.

Documents are scanned once for each block of items and never shuffled for it. Only words that the
block's items use have a number; a shingle with any other word is passed over at once. Of a
benchmark of several blocks one is with the executors at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import arrow_table, bounded_batches, slices, written

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
# Items, and bytes of them, sent to the executors at once; a larger benchmark is searched block
# by block.
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 32_000_000
BATCH_BYTES = 2_000_000
# Bits of the table that tells most shingles apart from sketched ones.
FILTER_BITS = 20
# ASCII but for letters and digits separates words.
SEPARATORS = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(SEPARATORS).split()


def _mixed(columns: Sequence[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of the numbers of a shingle's words."""
    mixed = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        mixed = (mixed ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _windows(numbers: np.ndarray, words: int) -> list[np.ndarray]:
    count = len(numbers) - words + 1
    return [numbers[i : i + count] for i in range(words)]


@dataclass(frozen=True)
class Item:
    item_id: int
    shingles: frozenset
    needed: int


@dataclass(frozen=True)
class Partition:
    """The items of one size class, and the hashes of their sketches, sorted, with their owners.
    ``least`` shingles are what the smallest of them needs."""

    items: list[Item]
    least: int
    hashes: np.ndarray
    owners: np.ndarray

    def candidates(self, found: np.ndarray) -> list[Item]:
        first = np.searchsorted(self.hashes, found)
        last = np.searchsorted(self.hashes, found, side="right")
        hits = np.flatnonzero(last > first)
        owners = {self.owners[i] for h in hits.tolist() for i in range(first[h], last[h])}
        return [self.items[owner] for owner in sorted(owners)]


class Block:
    """A block of items: words with numbers, and partitions by words of a shingle and by size."""

    def __init__(self, rows: Sequence[tuple[int, str]]):
        self.vocabulary: dict[bytes, int] = {}
        sketched: dict[tuple[int, int], list[tuple[Item, np.ndarray]]] = {}
        number = self.vocabulary.setdefault
        for item_id, text in rows:
            numbers = np.array([number(w, len(self.vocabulary) + 1) for w in words_of(text)])
            if not len(numbers):
                continue
            words = min(SHINGLE_WORDS, len(numbers))
            windows = _windows(numbers, words)
            shingles = frozenset(zip(*[w.tolist() for w in windows], strict=True))
            needed = -(-len(shingles) * 4 // 5)
            minima = np.unique(_mixed(windows))[: len(shingles) - needed + 1]
            size = (words, needed.bit_length())
            sketched.setdefault(size, []).append((Item(item_id, shingles, needed), minima))
        self.filters: dict[int, np.ndarray] = {}
        self.partitions: dict[int, list[Partition]] = {}
        for (words, _), members in sorted(sketched.items(), key=lambda m: m[0]):
            hashes = np.concatenate([minima for _, minima in members])
            owners = np.repeat(np.arange(len(members)), [len(minima) for _, minima in members])
            order = np.argsort(hashes, kind="stable")
            items = [item for item, _ in members]
            least = min(item.needed for item in items)
            part = Partition(items, least, hashes[order], owners[order])
            self.partitions.setdefault(words, []).append(part)
            known = self.filters.setdefault(words, np.zeros(1 << FILTER_BITS, bool))
            known[part.hashes >> np.uint64(64 - FILTER_BITS)] = True

    def search(self, texts: Sequence[str | None]) -> Iterator[tuple[int, Item, int]]:
        """(text, item, shared shingles) for each item contained in a text."""
        get = self.vocabulary.get
        for row, text in enumerate(texts):
            numbers = np.array([get(w, 0) for w in words_of(text)], np.int64)
            for words, partitions in self.partitions.items():
                for item, shared in self._held(numbers, words, partitions):
                    yield row, item, shared

    def _held(self, numbers: np.ndarray, words: int, partitions: list[Partition]):
        if len(numbers) < words:
            return
        known = np.convolve(numbers > 0, np.ones(words, np.int64), "valid")
        at = np.flatnonzero(known == words)
        if not len(at):
            return
        windows = [w[at] for w in _windows(numbers, words)]
        distinct = np.unique(_mixed(windows))
        found = distinct[self.filters[words][distinct >> np.uint64(64 - FILTER_BITS)]]
        shingles: set | None = None
        for partition in partitions if len(found) else ():
            # Partitions go up by size: this one's items, and all later ones, need more.
            if partition.least > len(distinct):
                return
            for item in partition.candidates(found):
                if shingles is None:
                    shingles = set(zip(*[w.tolist() for w in windows], strict=True))
                shared = len(item.shingles & shingles)
                if shared >= item.needed:
                    yield item, shared


FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("shared", pa.int64()),
        ("shingles", pa.int64()),
    ]
)
FOUND_DDL = "doc_id bigint, item_id bigint, shared bigint, shingles bigint"


def _blocks(benchmark: DataFrame) -> Iterator[Block]:
    """Blocks of about ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` at most, one in memory at a time."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("bigint"), "text")
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    number = max(1, -(-size["n"] // BLOCK_ITEMS), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(number))
    for i in range(number):
        rows = items.where(place == i).distinct().orderBy("item_id", "text").collect()
        yield Block([(r["item_id"], r["text"]) for r in rows])


def contained(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that it contains: doc_id, item_id, the number of
    the item's shingles, how many of them the document shares, and their ratio.

    Words are runs of letters, digits and non-ASCII characters, in lower case. An item of one to
    four words is contained where they stand side by side; items that are null or have no word
    match nothing. Repeated documents are answered one by one, repeated items once; null texts
    contain nothing, an empty table on either side gives no rows, and other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    found = docs.sparkSession.createDataFrame([], FOUND_DDL)
    for block in _blocks(benchmark):
        found = found.unionByName(_searched(rows, block, _searcher, FOUND_DDL))
    ratio = F.col("shared") / F.col("shingles")
    return found.withColumn("containment", ratio)


def _searched(rows: DataFrame, block: Block, searcher, schema) -> DataFrame:
    """What a search for the block's items makes of the rows, written, so that the executors can
    forget the block."""
    shared = rows.sparkSession.sparkContext.broadcast(block)
    found = written(rows.mapInArrow(searcher(shared), schema), "searched")
    shared.destroy()
    return found


def _searcher(shared):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            found = list(shared.value.search(_texts(batch.column("text"))))
            yield arrow_table(
                FOUND,
                [ids[row] for row, _, _ in found],
                [item.item_id for _, item, _ in found],
                [n for _, _, n in found],
                [len(item.shingles) for _, item, _ in found],
            )

    return search


def _texts(column: pa.Array) -> Iterator[str | None]:
    for start, end in slices(column, BATCH_BYTES):
        yield from column.slice(start, end - start).to_pylist()


def _keeper(shared):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            stays = np.ones(batch.num_rows, bool)
            stays[[row for row, _, _ in shared.value.search(_texts(batch.column(at)))]] = False
            yield batch.filter(pa.array(stays))

    return keep


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text contains no benchmark item; see
    ``contained``. Rows with null text or null doc_id are judged like any other. What one block
    leaves is written before the next one is searched for."""
    bounded_batches(docs.sparkSession)
    for block in _blocks(benchmark):
        docs = _searched(docs, block, _keeper, docs.schema)
    return docs


ORACLE = r"""
WITH doc_words AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(lower(text), '(?:[a-z0-9]|[^\x00-\x7F])+') AS w
    FROM documents
), doc_shingles AS (
    SELECT DISTINCT r, doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
    FROM doc_words, unnest(range(1, len(w) - 3)) AS places(i)
), item_words AS (
    SELECT item_id, text, regexp_extract_all(lower(text), '(?:[a-z0-9]|[^\x00-\x7F])+') AS w
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
), item_shingles AS (
    SELECT DISTINCT item_id, text, array_to_string(w[i : i + 4], ' ') AS shingle
    FROM item_words, unnest(range(1, len(w) - 3)) AS places(i)
), items AS (
    SELECT *, count(*) OVER (PARTITION BY item_id, text) AS shingles FROM item_shingles
)
SELECT doc_id, item_id, count(*) AS shared, shingles, count(*) / shingles AS containment
FROM doc_shingles JOIN items USING (shingle)
GROUP BY r, doc_id, item_id, text, shingles
HAVING count(*) * 5 >= shingles * 4
UNION ALL
SELECT doc_id, item_id, 1, 1, 1.0
FROM item_words i JOIN doc_words d ON len(i.w) BETWEEN 1 AND 4
    AND contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || array_to_string(i.w, ' ') || ' ')
"""
