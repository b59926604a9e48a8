"""Packing documents into sequences of fixed length by patterns and least squares.

Documents are tokenized once and written as pieces of at most a sequence's length. A piece that
fills a sequence is one. For the others only the histogram of lengths matters: patterns of up to
three lengths that fill a sequence are enumerated, repeat counts that come near the histogram are
found by non-negative least squares and rounded without using any length more often than it
occurs, and what is left over is packed best fit, longest first, as counts too. The plan has a
size bounded by the length of a sequence, however many documents there are.

Pieces of one length are alike to the plan, which gives the k-th of them its place. So they are
numbered, by counting in blocks as in a counting sort, and each piece finds its sequence from its
number alone. The numbers are small rows; the ids move once to meet their places and once to
their sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import arrow_table, bounded_batches, gathered, written
from medallion.llm.counting import block_of_row_id, numbered
from medallion.llm.token_blocks import BATCH_BYTES, _encoder
from medallion.session import work_folder

LENGTH = 2_048
END_ID = 0
# Shorter pieces (as a share of a sequence) are kept out of the patterns: they fill what the
# longer ones leave.
FILLER = 1 / 8
ROUNDS = 200
PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int32()),
        ("ids", pa.binary()),
    ]
)
PIECES_DDL = "doc_id bigint, piece int, start bigint, length int, ids binary"


# Ids as bytes


def _packed(compress, ids: np.ndarray) -> bytes:
    """Compressed ids of two bytes each, or four where they need them; a first byte tells."""
    wide = len(ids) > 0 and int(ids.max()) >= 1 << 16
    return (b"\4" if wide else b"\2") + compress(ids.astype("<u4" if wide else "<u2").tobytes())


def unpacked(decompress, data: bytes) -> np.ndarray:
    return np.frombuffer(decompress(data[1:]), f"<u{data[0]}").astype("<u4")


# Plan


def patterns(counts: np.ndarray) -> np.ndarray:
    """Patterns of up to three of the lengths that occur in ``counts``, downwards, 0 for none,
    that fill a sequence to the last id."""
    length = len(counts) - 1
    occurs = counts > 0
    occurs[0] = True
    found = [np.zeros((0, 3), np.int64)]
    for first in np.flatnonzero(occurs)[:0:-1].tolist():
        second = np.flatnonzero(occurs[: min(first, length - first) + 1])
        third = length - first - second
        fits = third <= second
        second, third = second[fits], third[fits]
        known = occurs[third]
        found.append(np.stack([np.full(known.sum(), first), second[known], third[known]], axis=1))
    return np.concatenate(found)


def repeats(every: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """How often to use each pattern, as fractions: non-negative least squares on the histogram.

    Lengths weigh as much as they take. Multiplicative updates keep the counts positive and
    never raise the error.
    """
    size = len(counts)
    weight = (np.arange(size) / (size - 1)) ** 2  # squared, as the errors are

    def used(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(every[:, i], weights=x, minlength=size) for i in range(every.shape[1]))
        total[0] = 0
        return total

    def back(y: np.ndarray) -> np.ndarray:
        y = weight * y
        return sum(y[every[:, i]] for i in range(every.shape[1]))

    wanted = back(counts.astype(np.float64))
    x = np.full(len(every), counts.sum() / max(1, len(every)))
    for _ in range(rounds):
        x *= wanted / np.maximum(back(used(x)), 1e-300)
    return x


def rounded(x: np.ndarray, every: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Whole repeat counts whose sum keeps up with that of ``x``, none beyond what ``left`` has;
    ``left`` becomes what they leave."""
    whole = np.diff(np.floor(np.cumsum(x) + 0.5), prepend=0).astype(np.int64)
    for i in np.flatnonzero(whole).tolist():
        pattern = every[i][every[i] > 0].tolist()
        times = min(int(whole[i]), *(int(left[n]) // pattern.count(n) for n in set(pattern)))
        whole[i] = times
        for n in pattern:
            left[n] -= times
    return whole


def plan(counts: np.ndarray) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Sequences for pieces of which ``counts[n]`` have length n: runs of (length, how many) in
    each, and how many such sequences. Every piece has its place in one."""
    length, left = len(counts) - 1, counts.astype(np.int64).copy()
    every = patterns(np.where(np.arange(length + 1) < length * FILLER, 0, left))
    open_: dict[int, list[tuple[tuple, int]]] = {}

    def put(runs: tuple, free: int, many: int) -> None:
        if many:
            open_.setdefault(free, []).append((runs, many))

    whole = rounded(repeats(every, left), every, left)
    for i in np.flatnonzero(whole).tolist():
        pattern = every[i][every[i] > 0].tolist()
        runs = tuple((n, pattern.count(n)) for n in dict.fromkeys(pattern))
        put(runs, length - sum(pattern), int(whole[i]))
    _best_fit(left, length, open_, put)
    return [group for free in sorted(open_) for group in open_[free]]


def _best_fit(left: np.ndarray, length: int, open_: dict, put) -> None:
    """Packs what is left, longest first, each into the fullest open sequence that holds it;
    where none does, as many as fit into new ones. Alike sequences are filled together."""
    for n in np.flatnonzero(left)[::-1].tolist():
        many = int(left[n])
        for free in sorted(f for f in open_ if f >= n):
            groups, open_[free] = open_[free], []
            for runs, alike in groups:
                each = free // n
                full, rest = divmod(min(many, alike * each), each)
                put(runs + ((n, each),), free - n * each, full)
                if rest:
                    put(runs + ((n, rest),), free - n * rest, 1)
                put(runs, free, alike - full - (rest > 0))
                many -= full * each + rest
            if not many:
                break
        full, rest = divmod(many, length // n)
        put(((n, length // n),), length - n * (length // n), full)
        if rest:
            put(((n, rest),), length - n * rest, 1)


class Places:
    """Where the k-th piece of each length goes: runs of numbers as columns, by length and first
    number."""

    def __init__(self, groups):
        taken: dict[int, int] = {}
        rows, sequence = [], 0
        for runs, many in groups:
            offset = 0
            for n, each in runs:
                rows.append((n, taken.get(n, 0), each, sequence, offset))
                taken[n] = taken.get(n, 0) + each * many
                offset += n * each
            sequence += many
        rows.sort()
        table = np.array(rows, np.int64).reshape(len(rows), 5)
        self.length, self.first, self.each, self.sequence, self.offset = table.T.copy()
        self.keys = self._key(self.length, self.first)
        self.sequences = sequence

    @staticmethod
    def _key(length: np.ndarray, number: np.ndarray) -> np.ndarray:
        return (length << 48) + number

    def of(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of that length and number."""
        run = np.searchsorted(self.keys, self._key(length, number), side="right") - 1
        nth = number - self.first[run]
        turn, inside = np.divmod(nth, self.each[run])
        return self.sequence[run] + turn, self.offset[run] + inside * length


# Documents


def write_pieces(docs: DataFrame, path: str, tokenizer: str, length: int = LENGTH) -> None:
    """Write the ids of each text of ``docs`` and an end id in pieces of ``length``; only the
    last of a document may be shorter. Pieces that fill a sequence lie in a folder of their own.
    ``_place`` numbers all pieces uniquely."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, compress = _encoder(tokenizer), zstandard.ZstdCompressor(level=1).compress
        for some in gathered(batches, "text", BATCH_BYTES):
            rows = []
            for doc_id, ids in zip(some.column("doc_id").to_pylist(), known.encode(some.column("text")), strict=True):
                ids[-1] = END_ID
                for number, start in enumerate(range(0, len(ids), length)):
                    part = ids[start : start + length]
                    rows.append((doc_id, number, start, len(part), _packed(compress, part)))
            yield arrow_table(PIECES, *zip(*rows, strict=True))

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    cut = rows.mapInArrow(pieces, PIECES_DDL).withColumn("_place", F.monotonically_increasing_id())
    cut.withColumn("whole", F.col("length") == length).write.partitionBy("whole").parquet(path)


def _placed(pieces: DataFrame, length: int) -> DataFrame:
    """``_place`` of each piece with its sequence and offset."""
    small = pieces.select("_place", "length")
    counts = np.zeros(length + 1, np.int64)
    # One row per length.
    for row in small.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["length"]] = row["n"]
    places = Places(plan(counts))
    blocks = small.withColumn("_block", block_of_row_id("_place"))
    ordinal = numbered(blocks, "length", "_block", "_place", "_number")

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy().astype(np.int64)
            sequence, offset = places.of(lengths, batch.column("_number").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_place"), pa.array(sequence), pa.array(offset)],
                ["_place", "sequence_id", "offset"],
            )

    ddl = "_place bigint, sequence_id bigint, offset bigint"
    return ordinal.select("_place", "length", "_number").mapInArrow(locate, ddl)


PACKED_DDL = (
    "sequence_id bigint, doc_ids array<bigint>, pieces array<int>, starts array<bigint>, "
    "lengths array<int>, ids binary"
)
PACKED = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("pieces", pa.list_(pa.int32())),
        ("starts", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
        ("ids", pa.binary()),
    ]
)


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of sequence and offset to one row per sequence."""
    compress = zstandard.ZstdCompressor(level=3).compress
    decompress = zstandard.ZstdDecompressor().decompress

    def row(held: list[dict]) -> tuple:
        ids = np.concatenate([unpacked(decompress, p["ids"]) for p in held])
        lists = [[p[c] for p in held] for c in ("doc_id", "piece", "start", "length")]
        return (held[0]["sequence_id"], *lists, _packed(compress, ids))

    held: list[dict] = []
    for batch in batches:
        done = []
        for piece in batch.to_pylist():
            if held and piece["sequence_id"] != held[0]["sequence_id"]:
                done.append(row(held))
                held = []
            held.append(piece)
        if done:
            yield arrow_table(PACKED, *zip(*done, strict=True))
    if held:
        yield arrow_table(PACKED, *zip(*[row(held)], strict=True))


def pack(docs: DataFrame, path: str, tokenizer: str, length: int = LENGTH) -> None:
    """Write the texts of ``docs`` as sequences of at most ``length`` ids below ``path``.

    A sequence is a row of ``PACKED``: its ids, and of each piece in it, in order, the document,
    the piece's number there, its first id there and its length. ``pieces/whole=true`` holds
    the pieces that are sequences. A null text is an empty one, of the end id alone; repeated
    rows and rows without id are documents like any other; other columns are ignored.
    """
    spark = docs.sparkSession
    write_pieces(docs, f"{path}/pieces", tokenizer, length)
    pieces = _pieces(spark, path).where("not whole")
    places = written(_placed(pieces, length), "places")
    # The small side is hashed; the ids are not sorted for the join.
    meeting = pieces.join(places.hint("shuffle_hash"), "_place")
    meeting = meeting.select("sequence_id", "offset", *PIECES.names)
    ordered = meeting.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    ordered.mapInArrow(_join_pieces, PACKED_DDL).write.parquet(f"{path}/sequences")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{PIECES_DDL}, _place bigint, whole boolean").parquet(f"{path}/pieces")


def sequences(spark: SparkSession, path: str) -> DataFrame:
    """All sequences below ``path``, one row each; ids as ``unpacked`` reads them. Those that a
    piece fills have negative numbers."""
    joined = spark.read.schema(PACKED_DDL).parquet(f"{path}/sequences")
    alone = _pieces(spark, path).where("whole").select(
        (-1 - F.col("_place")).alias("sequence_id"),
        F.array("doc_id").alias("doc_ids"),
        F.array("piece").alias("pieces"),
        F.array("start").alias("starts"),
        F.array("length").alias("lengths"),
        "ids",
    )
    return joined.unionByName(alone)


DIGESTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
DIGESTS_DDL = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
    "sequence_id bigint, offset bigint"
)


def digests(stored: DataFrame) -> DataFrame:
    """The pieces in ``sequences``, each with the checksum of its ids and its place."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            lengths = batch.column("lengths")
            many = pc.list_value_length(lengths).to_numpy()
            size = lengths.flatten().to_numpy().astype(np.int64)
            sums, offsets = [], []
            for ids, own in zip(batch.column("ids"), np.split(size, np.cumsum(many)[:-1]), strict=True):
                data = unpacked(decompress, ids.as_py()).tobytes()
                ends = np.cumsum(own)
                offsets.append(ends - own)
                sums += [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), own.tolist())]
            flat = (batch.column(c).flatten() for c in ("doc_ids", "pieces", "starts"))
            sequence = np.repeat(batch.column("sequence_id").to_numpy(), many)
            yield arrow_table(DIGESTS, *flat, size, sums, sequence, np.concatenate(offsets))

    return stored.mapInArrow(digest, DIGESTS_DDL)


def packed(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` packed into a new folder of the shared folder and read back; see ``pack`` and
    ``digests``. An empty table gives no rows."""
    path = work_folder(docs.sparkSession, "packed")
    pack(docs, path, tokenizer)
    return digests(sequences(docs.sparkSession, path))
