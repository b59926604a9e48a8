"""Token ids in patched frame-of-reference blocks.

Documents are tokenized and written in ascending doc_id order as segments of whole documents.
A segment is one binary value, a row of a Parquet table with the part and segment number, so
that Spark's writers commit it on any file system and a lost task leaves nothing behind.

Layout of a segment, little-endian:

    "PFR1"  documents u4  blocks u4  ids u8
    per document: doc_id i8, null flag u1 (all flags after all ids), ids u4
    per block: offset of the block in the segment u4, and the end of the last
    blocks of 128 ids, the last one filled up with its minimum:
        minimum u4, width u1, exceptions u1
        128 differences from the minimum in ``width`` bits each
        positions u1 of the exceptions, their differences u4

The width is that of the 90th percentile of the differences; larger ones are exceptions, whose
packed bits are zero.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import arrow_table, bounded_batches, gathered
from medallion.session import work_folder

MAGIC = b"PFR1"
BLOCK = 128
PERCENTILE = 0.9
HEAD = 6
END_ID = 1
SEGMENT_IDS = 1 << 17
BATCH_BYTES = 2_000_000
# Words of plain letters, and others, whose ids a worker keeps; emptied when full.
KEPT_WORDS = 200_000
# What goes to the tokenizer at once: words in a text, and texts.
WORDS_A_CALL, TEXTS_A_CALL = 100, 100
# How the tokenizer marks the last token of a word.
WORD_END = "</w>"
# Words of Latin letters whose lower case is one letter too, and ASCII marks.
LETTERS = "^[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u024F]+$"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


# Blocks


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 128 values packed in ``width`` bits each."""
    kind, size = ("<u2", 16) if width <= 16 else ("<u4", 32)
    bits = np.unpackbits(values.astype(kind).view(np.uint8), axis=1, bitorder="little")
    bits = bits.reshape(len(values), BLOCK, size)[:, :, :width]
    return np.packbits(bits.reshape(len(values), -1), axis=1, bitorder="little")


def _values(packed: np.ndarray, width: int) -> np.ndarray:
    kind, size = ("<u2", 16) if width <= 16 else ("<u4", 32)
    bits = np.zeros((len(packed), BLOCK, size), np.uint8)
    unpacked = np.unpackbits(packed, axis=1, bitorder="little", count=BLOCK * width)
    bits[:, :, :width] = unpacked.reshape(len(packed), BLOCK, width)
    return np.packbits(bits.reshape(len(packed), -1), axis=1, bitorder="little").view(kind)


def _widths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack(doc_ids: Sequence[int | None], documents: Sequence[np.ndarray]) -> bytes:
    """A segment of documents, each an array of unsigned 32-bit ids."""
    lengths = np.array([len(d) for d in documents], "<u4")
    ids = np.concatenate([*documents, np.zeros(0, "<u4")]).astype(np.int64)
    count = -(-len(ids) // BLOCK)
    minima, blocks = np.zeros(0, np.int64), []
    if count:
        minima = np.minimum.reduceat(ids, np.arange(0, len(ids), BLOCK))
        filled = np.concatenate([ids, np.full(count * BLOCK - len(ids), minima[-1])])
        deltas = filled.reshape(count, BLOCK) - minima[:, None]
        kept = np.partition(deltas, int(PERCENTILE * BLOCK) - 1, axis=1)[:, int(PERCENTILE * BLOCK) - 1]
        widths = _widths(kept)
        outside = deltas >> widths[:, None].astype(np.int64) > 0
        packed = [b""] * count
        low = np.where(outside, 0, deltas)
        for width in np.unique(widths[widths > 0]):
            rows = np.flatnonzero(widths == width)
            for row, data in zip(rows.tolist(), _bits(low[rows], int(width)), strict=True):
                packed[row] = data.tobytes()
        heads = np.zeros((count, HEAD), np.uint8)
        heads[:, :4] = minima.astype("<u4").view(np.uint8).reshape(-1, 4)
        heads[:, 4], heads[:, 5] = widths, outside.sum(axis=1)
        row, position = np.nonzero(outside)
        ends = np.cumsum(heads[:, 5], dtype=np.int64)
        positions, exceptions = position.astype(np.uint8), deltas[row, position].astype("<u4")
        start = 0
        for i, end in enumerate(ends.tolist()):
            blocks.append(
                heads[i].tobytes() + packed[i] + positions[start:end].tobytes() + exceptions[start:end].tobytes()
            )
            start = end
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    named = np.array([0 if d is None else d for d in doc_ids], "<i8")
    front = MAGIC + np.array([len(doc_ids), count], "<u4").tobytes()
    front += np.array([len(ids)], "<u8").tobytes()
    front += named.tobytes() + nulls.tobytes() + lengths.tobytes()
    first = len(front) + 4 * (count + 1)
    starts = np.array(list(accumulate(map(len, blocks), initial=first)), "<u4")
    return b"".join([front, starts.tobytes(), *blocks])


def unpack(segment: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    """What ``pack`` was given."""
    if segment[:4] != MAGIC:
        raise ValueError("not a segment of token ids")
    documents, count = np.frombuffer(segment, "<u4", 2, 4).tolist()
    total = int(np.frombuffer(segment, "<u8", 1, 12)[0])
    at = 20
    named = np.frombuffer(segment, "<i8", documents, at).tolist()
    nulls = np.frombuffer(segment, np.uint8, documents, at + 8 * documents)
    lengths = np.frombuffer(segment, "<u4", documents, at + 9 * documents)
    starts = np.frombuffer(segment, "<u4", count + 1, at + 13 * documents).astype(np.int64)
    ids = _blocks(np.frombuffer(segment, np.uint8), starts[:-1])[:total]
    doc_ids = [None if null else d for d, null in zip(named, nulls.tolist(), strict=True)]
    return doc_ids, np.split(ids, np.cumsum(lengths.astype(np.int64))[:-1]) if documents else []


def _blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts``: any of them, as the index allows."""
    heads = data[starts[:, None] + np.arange(HEAD)]
    minima = np.ascontiguousarray(heads[:, :4]).view("<u4").astype(np.int64)
    widths, exceptions = heads[:, 4].astype(np.int64), heads[:, 5].astype(np.int64)
    deltas = np.zeros((len(starts), BLOCK), np.int64)
    for width in np.unique(widths[widths > 0]).tolist():
        rows = np.flatnonzero(widths == width)
        inside = starts[rows, None] + HEAD + np.arange(width * BLOCK // 8)
        deltas[rows] = _values(data[inside], width)
    row = np.repeat(np.arange(len(starts)), exceptions)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    begin = starts + HEAD + widths * BLOCK // 8
    values = begin[row, None] + exceptions[row, None] + 4 * nth[:, None] + np.arange(4)
    deltas[row, data[begin[row] + nth]] = np.ascontiguousarray(data[values]).view("<u4").ravel()
    return (deltas + minima).ravel().astype("<u4")


# Tokens


class Known:
    """Words and their ids, held as columns: the words, and for each where its ids begin and how
    many they are."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, "<u4")

    def places(self, words: pa.Array) -> np.ndarray:
        """The row of each of the words, all different; unknown ones are encoded first."""
        if len(self.words) > KEPT_WORDS:
            self.forget()
        found = pc.index_in(words, value_set=self.words)
        unknown = found.is_null().to_numpy(zero_copy_only=False)
        rows = found.fill_null(0).to_numpy().astype(np.int64)
        if unknown.any():
            new = words.filter(pa.array(unknown))
            ids, sizes = self.encode(new.to_pylist())
            rows[unknown] = len(self.words) + np.arange(len(new))
            self.words = pa.concat_arrays([self.words, new])
            self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
        return rows


class Encoder:
    """Encodes texts word by word with the tokenizers library and remembers words.

    The tokenizer's rules never join characters across ASCII white space and drop it, so the
    ids of a text are those of its words, one after the other. A word of Latin letters and
    trailing ASCII marks is cut between them, as the tokenizer does; such letters are encoded
    in one call for many words and told apart by their last tokens.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # For lower-case Latin words between blanks its normal form and its cuts change nothing.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(False, use_regex=False)]
        )
        size = self.tokenizer.get_vocab_size()
        tokens = map(self.tokenizer.id_to_token, range(size))
        self.last = np.array([(t or "").endswith(WORD_END) for t in tokens])
        self.letters, self.others = Known(self._letters), Known(self._whole)

    def encode(self, texts: pa.Array | Sequence[str | None]) -> list[np.ndarray]:
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        words = lists.flatten().dictionary_encode()
        which = words.indices.to_numpy()
        sizes, starts, before = [], [], 0
        # Each word is its letters and what follows them, either of which may be nothing.
        for known, part in zip((self.letters, self.others), _cut(words.dictionary), strict=True):
            part = part.dictionary_encode()
            rows = known.places(part.dictionary)[part.indices.to_numpy()][which]
            sizes.append(known.sizes[rows])
            starts.append(before + (np.cumsum(known.sizes) - known.sizes)[rows])
            before += len(known.ids)
        lengths, firsts = np.stack(sizes, axis=1).ravel(), np.stack(starts, axis=1).ravel()
        ends = np.concatenate(([0], np.cumsum(lengths)))
        at = np.repeat(firsts - ends[:-1], lengths) + np.arange(ends[-1])
        ids = np.concatenate([self.letters.ids, self.others.ids])[at]
        bounds = ends[2 * (lists.offsets.to_numpy() - lists.offsets[0].as_py())].tolist()
        last = np.array([END_ID], "<u4")
        return [np.concatenate([ids[a:b], last]) for a, b in zip(bounds, bounds[1:], strict=False)]

    def _whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = _ids(self.tokenizer, words)
        return np.concatenate([*ids, np.zeros(0, "<u4")]), np.array([len(i) for i in ids], np.int64)

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters; the empty word has no ids."""
        groups = [words[i : i + WORDS_A_CALL] for i in range(0, len(words), WORDS_A_CALL)]
        ids = np.concatenate([*_ids(self.plain, [" ".join(g) for g in groups]), np.zeros(0, "<u4")])
        ends = np.concatenate(([0], np.flatnonzero(self.last[ids]) + 1))
        sizes = np.array([1 if word else 0 for word in words], np.int64)
        if len(ends) - 1 != sizes.sum():
            raise ValueError("the tokenizer does not mark the end of each word")
        sizes[sizes > 0] = np.diff(ends)
        return ids, sizes


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _ids(tokenizer, texts: list[str]) -> list[np.ndarray]:
    found: list[np.ndarray] = []
    for start in range(0, len(texts), TEXTS_A_CALL):
        encoded = tokenizer.encode_batch_fast(texts[start : start + TEXTS_A_CALL], add_special_tokens=False)
        found += [np.array(e.ids, "<u4") for e in encoded]
    return found


def _cut(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words of Latin letters, in lower case, and the marks after them; other words are all in
    the second part."""
    trimmed = pc.utf8_rtrim(words, characters=MARKS)
    plain = pc.match_substring_regex(trimmed, LETTERS)
    letters = pc.if_else(plain, pc.utf8_lower(trimmed), "")
    skipped = np.where(plain.to_numpy(zero_copy_only=False), pc.binary_length(trimmed).to_numpy(), 0)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    lengths = np.diff(offsets) - skipped
    ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    at = np.repeat(offsets[:-1] + skipped - ends[:-1], lengths) + np.arange(ends[-1])
    rest = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at]
    return letters, pa.StringArray.from_buffers(len(words), pa.py_buffer(ends), pa.py_buffer(rest))


SEGMENTS = pa.schema(
    [
        ("part", pa.int32()),
        ("segment", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("data", pa.binary()),
    ]
)
SEGMENTS_DDL = "part int, segment int, first bigint, n_ids bigint, data binary"


def write(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Write the ids of each text of ``docs``, and an end id, as segments below ``path``.

    Rows are in ascending doc_id order, null ids first, equal ids by text, nulls first; a null
    text is an empty one, which has the end id only.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        doc_ids: list[int | None] = []
        documents: list[np.ndarray] = []
        number = first = held = 0

        def segment() -> pa.RecordBatch:
            return arrow_table(SEGMENTS, [part], [number], [first], [held], [pack(doc_ids, documents)])

        for some in gathered(batches, "text", BATCH_BYTES):
            encoded = encoder.encode(some.column("text"))
            for doc_id, ids in zip(some.column("doc_id").to_pylist(), encoded, strict=True):
                doc_ids.append(doc_id)
                documents.append(ids)
                held += len(ids)
                if held >= SEGMENT_IDS:
                    yield segment()
                    number, first, held = number + 1, first + held, 0
                    doc_ids, documents = [], []
        if doc_ids:
            yield segment()

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    ordered = rows.repartitionByRange(F.asc_nulls_first("doc_id"))
    ordered = ordered.sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    ordered.mapInArrow(segments, SEGMENTS_DDL).write.parquet(path)


DIGESTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of each document
    in the segments below ``path``.

    Of the ids before a segment, those in earlier parts come from one total per part.
    """
    stored = spark.read.schema(SEGMENTS_DDL).parquet(path)
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("ids")).orderBy("part").collect()
    before = dict(zip([r["part"] for r in totals], accumulate([r["ids"] for r in totals], initial=0)))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                doc_ids, documents = unpack(row["data"])
                lengths = [len(d) for d in documents]
                start = before[row["part"]] + row["first"]
                yield arrow_table(
                    DIGESTS,
                    doc_ids,
                    list(accumulate(lengths, initial=start))[:-1],
                    lengths,
                    [zlib.crc32(d.tobytes()) for d in documents],
                )

    return stored.mapInArrow(digests, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` written to a new folder of the shared folder and read back; see ``write`` and
    ``read``. Repeated rows are written as often as they occur, an empty table gives no rows,
    and other columns are ignored."""
    path = work_folder(docs.sparkSession, "tokens")
    write(docs, path, tokenizer)
    return read(docs.sparkSession, path)
