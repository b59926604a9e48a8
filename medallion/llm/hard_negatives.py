"""Hard negatives out of Hilbert-ordered blocks with zone maps.

Vectors of whole numbers are sorted along a Hilbert curve through their space and cut into blocks
of neighbours, rows of a Parquet table: the vectors in one column, and beside them the least and
greatest value of each dimension, the block's zone map. The inner product of an anchor with any
vector of a block lies within the interval that the zone map gives, so that a block whose
interval misses an anchor's window need not be read for it.

A search looks for the best rows of each anchor in each of its windows of scores, in three steps:

1. an anchor's own shelf, as many blocks in a row along the curve, gives a score that the last
   of its best rows reaches at least;
2. zone maps alone, in tiles of zone maps against groups of anchors, say which blocks may hold a
   row that does;
3. these blocks, and no others, are joined with their anchors, scored, and the best rows kept.

Nothing is approximate. It runs twice: for the positives, in one window without limits, and for
the negatives, in a window per positive. Anchors are a stated query set: they meet blocks in
tiles, and every task holds at most one tile or shelf and one group of anchors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import arrow_table, written

SCALE = 256
# Anchors' ids are multiples of the first; the label of multiples of the second is turned.
ANCHORS, TURNED, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
# Negatives' share of the positive's score, per cent.
LOWEST, HIGHEST = 30, 90
# Larger vectors take no part: inner products, and 100 times them, stay within a bigint.
LARGEST = float(1 << 19)
KEY_BITS = 6
# Rows of a block, blocks of a shelf, shelves of a tile of zone maps, anchors of a group.
BLOCK, SHELF, TILE, GROUP = 128, 64, 64, 4_096
SCORED_AT_ONCE = 256
NO_LIMIT = 1 << 62
EXACT_DOUBLE = 1 << 53


# The curve


def hilbert_keys(cells: np.ndarray, bits: int = KEY_BITS) -> np.ndarray:
    """Places along a Hilbert curve of rows of cell numbers below ``2**bits``, as rows of bytes
    in the order of the curve (the transposed form of Skilling's algorithm)."""
    axes = cells.astype(np.uint32).T.copy()
    top = np.uint32(1 << (bits - 1))
    bit = top
    while bit > 1:
        below = bit - np.uint32(1)
        for axis in axes:
            flip = (axis & bit) != 0
            swap = np.where(flip, 0, (axes[0] ^ axis) & below)
            axes[0] ^= np.where(flip, below, swap)
            axis ^= np.where(flip, 0, swap) if axis is not axes[0] else 0
        bit >>= np.uint32(1)
    for number in range(1, len(axes)):
        axes[number] ^= axes[number - 1]
    turn = np.zeros(axes.shape[1], np.uint32)
    bit = top
    while bit > 1:
        turn ^= np.where((axes[-1] & bit) != 0, bit - np.uint32(1), 0)
        bit >>= np.uint32(1)
    axes ^= turn
    levels = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    spread = (axes.T[:, None, :] >> levels[None, :, None]) & 1
    return np.packbits(spread.reshape(len(spread), -1).astype(np.uint8), axis=1)


# Rows and blocks


def _usable() -> Column:
    """True for rows with id, label and a vector of finite components of bounded size."""
    limit = F.lit(LARGEST) / F.sqrt(F.size("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= limit))
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
    return F.coalesce(known & fine, F.lit(False))


def labelled(vectors: DataFrame) -> DataFrame:
    """The rows that take part, with the labels they take part under and a number of their own."""
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.monotonically_increasing_id().alias("row"),
    ).where(_usable())
    turned = (F.col("label") + 1) % LABELS
    return rows.withColumn("label", F.when(F.col("vec_id") % TURNED == 0, turned).otherwise(F.col("label")))


ROWS = pa.schema(
    [
        ("row", pa.int64()),
        ("vec_id", pa.int64()),
        ("label", pa.int32()),
        ("dim", pa.int32()),
        ("key", pa.binary()),
        ("vector", pa.binary()),
    ]
)
ROWS_DDL = "row bigint, vec_id bigint, label int, dim int, key binary, vector binary"


def _whole_numbers(rows: DataFrame) -> DataFrame:
    """The vectors as whole numbers, with their keys along the curve."""
    least, most = F.min(F.array_min("embedding")), F.max(F.array_max("embedding"))
    ends = rows.agg(least.alias("least"), most.alias("most")).first()
    low = int(np.floor(SCALE * (ends["least"] or 0.0)))
    shift = max(0, (int(np.floor(SCALE * (ends["most"] or 0.0))) - low).bit_length() - KEY_BITS)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.diff(batch.column("embedding").offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                flat = part.column("embedding").flatten().to_numpy(zero_copy_only=False)
                numbers = np.floor(SCALE * flat.reshape(-1, dim)).astype(np.int64)
                keys = hilbert_keys((numbers - low) >> shift)
                yield arrow_table(
                    ROWS,
                    *(part.column(c) for c in ("row", "vec_id", "label")),
                    np.full(len(keys), dim),
                    [k.tobytes() for k in keys],
                    [v.tobytes() for v in numbers.astype("<i4")],
                )

    return rows.mapInArrow(convert, ROWS_DDL)


BLOCKS = pa.schema(
    [
        ("dim", pa.int32()),
        ("shelf", pa.int64()),
        ("block", pa.int64()),
        ("zone_labels", pa.list_(pa.int32())),
        ("lows", pa.binary()),
        ("highs", pa.binary()),
        ("rows", pa.list_(pa.int64())),
        ("vec_ids", pa.list_(pa.int64())),
        ("labels", pa.list_(pa.int32())),
        ("vectors", pa.binary()),
    ]
)
BLOCKS_DDL = (
    "dim int, shelf bigint, block bigint, zone_labels array<int>, lows binary, highs binary, "
    "rows array<bigint>, vec_ids array<bigint>, labels array<int>, vectors binary"
)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of the curve to blocks; ids of shelves and blocks begin with the partition."""
    first = TaskContext.get().partitionId() << 33
    number, held = 0, None

    def block(rows: pa.RecordBatch) -> pa.RecordBatch:
        dim = rows.column("dim")[0].as_py()
        data = b"".join(rows.column("vector").to_pylist())
        matrix = np.frombuffer(data, "<i4").reshape(-1, dim)
        labels = rows.column("label").to_numpy()
        return arrow_table(
            BLOCKS,
            [dim],
            [first + number // SHELF],
            [first + number],
            [np.unique(labels)],
            [matrix.min(axis=0).tobytes()],
            [matrix.max(axis=0).tobytes()],
            [rows.column("row").to_numpy()],
            [rows.column("vec_id").to_numpy()],
            [labels],
            [data],
        )

    for batch in batches:
        rows = batch if held is None else pa.concat_batches([held, batch])
        held = None
        dims = rows.column("dim").to_numpy()
        edges = np.flatnonzero(np.diff(dims)) + 1
        for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(dims)], strict=True):
            for at in range(start, end, BLOCK):
                piece = rows.slice(at, min(BLOCK, end - at))
                if end == len(dims) and at + BLOCK > end:
                    held = piece  # may go on in the next batch
                    continue
                yield block(piece)
                number += 1
            if end < len(dims):
                number = -(-number // SHELF) * SHELF  # another dimension, another shelf
    if held is not None and held.num_rows:
        yield block(held)


def blocks_of(rows: DataFrame) -> DataFrame:
    """All rows in blocks along the curve, as a written table."""
    order = ("dim", "key", "vec_id", "row")
    placed = _whole_numbers(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    return written(placed.mapInArrow(_cut, BLOCKS_DDL), "blocks")


ANCHOR = pa.schema(
    [
        ("row", pa.int64()),
        ("vec_id", pa.int64()),
        ("label", pa.int32()),
        ("dim", pa.int32()),
        ("shelf", pa.int64()),
        ("vector", pa.binary()),
    ]
)
ANCHOR_DDL = "row bigint, vec_id bigint, label int, dim int, shelf bigint, vector binary"


def _anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in batch.to_pylist():
            ids = np.array(block["vec_ids"], np.int64)
            chosen = np.flatnonzero(ids % ANCHORS == 0)
            size = 4 * block["dim"]
            yield arrow_table(
                ANCHOR,
                np.array(block["rows"], np.int64)[chosen],
                ids[chosen],
                np.array(block["labels"], np.int32)[chosen],
                np.full(len(chosen), block["dim"]),
                np.full(len(chosen), block["shelf"]),
                [block["vectors"][i * size : (i + 1) * size] for i in chosen.tolist()],
            )


def anchors_of(blocks: DataFrame) -> DataFrame:
    """The anchors among the rows, in groups of neighbours along the curve."""
    found = blocks.select("dim", "shelf", "rows", "vec_ids", "labels", "vectors")
    found = found.mapInArrow(_anchors_of, ANCHOR_DDL)
    number = F.monotonically_increasing_id()
    return written(found.withColumn("group", F.floor(number / GROUP).cast("bigint")), "anchors")


# Search


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dim).astype(np.int64)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows; in doubles where these are exact."""
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * left.shape[1]
    if most < EXACT_DOUBLE:
        return left.astype(np.float64) @ right.T.astype(np.float64)
    return left @ right.T


def intervals(anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with any vector of each zone."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    least = _products(up, lows) + _products(down, highs)
    return least, _products(up, highs) + _products(down, lows)


class _Anchors:
    """Anchors of a task: vectors, labels, and for each window its limits. Rows with fewer
    windows are filled up with empty ones."""

    def __init__(self, table: pa.Table):
        self.rows, self.labels = table.column("row").to_numpy(), table.column("label").to_numpy()
        self.vectors = _matrix(table.column("vector"), table.column("dim")[0].as_py())
        lows, highs = table.column("low").to_pylist(), table.column("high").to_pylist()
        windows = max(map(len, lows))
        self.low = np.full((len(lows), windows), NO_LIMIT, np.int64)
        self.high = np.full((len(lows), windows), -NO_LIMIT, np.int64)
        for i, (low, high) in enumerate(zip(lows, highs, strict=True)):
            self.low[i, : len(low)], self.high[i, : len(high)] = low, high


class _Candidates:
    """Rows of the blocks of a task, by id: equal scores then stay in that order."""

    def __init__(self, table: pa.Table):
        blocks = table.select(["dim", "rows", "vec_ids", "labels", "vectors"])
        rows, ids = (np.concatenate([np.array(x) for x in blocks.column(c).to_pylist()]) for c in ("rows", "vec_ids"))
        labels = np.concatenate([np.array(x) for x in blocks.column("labels").to_pylist()])
        vectors = _matrix(blocks.column("vectors"), blocks.column("dim")[0].as_py())
        order = np.lexsort((rows, ids))
        many = [len(x) for x in blocks.column("rows").to_pylist()]
        self.block = np.repeat(np.arange(len(many)), many)[order]
        self.rows, self.ids, self.labels, self.vectors = rows[order], ids[order], labels[order], vectors[order]


def _best(anchors: _Anchors, rows: _Candidates, limit: int, same: bool, read: np.ndarray | None = None):
    """(anchor, window, candidates, their scores) of the best ``limit`` rows in each window, best
    first. ``read`` says which anchors look into which blocks."""
    for start in range(0, len(anchors.rows), SCORED_AT_ONCE):
        some = slice(start, start + SCORED_AT_ONCE)
        scores = _products(anchors.vectors[some], rows.vectors)
        allowed = (anchors.labels[some, None] == rows.labels) == same
        allowed &= anchors.rows[some, None] != rows.rows
        if read is not None:
            allowed &= read[some][:, rows.block]
        low, high = anchors.low[some].min(axis=1), anchors.high[some].max(axis=1)
        allowed &= (scores >= low[:, None]) & (scores <= high[:, None])
        for i in range(len(scores)):
            found = np.flatnonzero(allowed[i])
            down = -scores[i, found]
            order = np.argsort(down, kind="stable")
            found, down = found[order], down[order]
            for window in range(anchors.low.shape[1]):
                least, most = anchors.low[start + i, window], anchors.high[start + i, window]
                if least > most:
                    continue
                begin = np.searchsorted(down, -most)
                end = min(begin + limit, np.searchsorted(down, -least, side="right"))
                if begin < end:
                    yield start + i, window, found[begin:end], -down[begin:end]


def _floors(limit: int, same: bool):
    """An anchor's windows, narrowed by what its own shelf has to offer."""
    schema = pa.schema([("row", pa.int64()), ("low", pa.list_(pa.int64()))])

    def narrow(blocks: pa.Table, own: pa.Table) -> pa.Table:
        if not own.num_rows:
            return schema.empty_table()
        anchors = _Anchors(own)
        raised = anchors.low.copy()
        for anchor, window, _, scores in _best(anchors, _Candidates(blocks), limit, same):
            if len(scores) == limit:
                raised[anchor, window] = scores[-1]
        lows = [raised[i, : len(low)] for i, low in enumerate(own.column("low").to_pylist())]
        return pa.Table.from_batches([arrow_table(schema, anchors.rows, lows)])

    return narrow


NEEDED = pa.schema(
    [
        ("dim", pa.int32()),
        ("shelf", pa.int64()),
        ("block", pa.int64()),
        ("group", pa.int64()),
        ("readers", pa.binary()),
    ]
)
NEEDED_DDL = "dim int, shelf bigint, block bigint, group bigint, readers binary"


def _needed(same: bool):
    """The blocks of a tile that the windows of a group of anchors meet, and by which anchors."""

    def choose(key, zones: pa.Table, group: pa.Table) -> pa.Table:
        if not (zones.num_rows and group.num_rows):
            return NEEDED.empty_table()
        anchors = _Anchors(group.sort_by("row"))
        dim = anchors.vectors.shape[1]
        lows, highs = _matrix(zones.column("lows"), dim), _matrix(zones.column("highs"), dim)
        known = zones.column("zone_labels").to_pylist()
        read = np.zeros((len(anchors.rows), zones.num_rows), bool)
        for start in range(0, len(read), SCORED_AT_ONCE):
            some = slice(start, start + SCORED_AT_ONCE)
            least, most = intervals(anchors.vectors[some], lows, highs)
            for low, high in zip(anchors.low[some].T, anchors.high[some].T, strict=True):
                meets = (most >= low[:, None]) & (least <= high[:, None])
                read[some] |= meets & (low <= high)[:, None]
        for label in np.unique(anchors.labels).tolist():
            holds = [label in of if same else any(x != label for x in of) for of in known]
            read[anchors.labels == label] &= np.array(holds)
        chosen = np.flatnonzero(read.any(axis=0))
        readers = [np.packbits(read[:, i]).tobytes() for i in chosen.tolist()]
        where = pa.array(chosen)
        blocks = (zones.column(c).combine_chunks().take(where) for c in ("dim", "shelf", "block"))
        group_id = np.full(len(chosen), key[2].as_py())
        return pa.Table.from_batches([arrow_table(NEEDED, *blocks, group_id, readers)])

    return choose


HITS = pa.schema(
    [
        ("row", pa.int64()),
        ("window", pa.int32()),
        ("other_row", pa.int64()),
        ("other_id", pa.int64()),
        ("score", pa.int64()),
    ]
)
HITS_DDL = "row bigint, window int, other_row bigint, other_id bigint, score bigint"


def _read(limit: int, same: bool):
    def read(key, blocks: pa.Table, group: pa.Table) -> pa.Table:
        if not (blocks.num_rows and group.num_rows):
            return HITS.empty_table()
        anchors, rows = _Anchors(group.sort_by("row")), _Candidates(blocks)
        bits = np.stack([np.frombuffer(x, np.uint8) for x in blocks.column("readers").to_pylist()])
        readers = np.unpackbits(bits, axis=1, count=len(anchors.rows)).T.astype(bool)
        found = [arrow_table(HITS, *([] for _ in HITS))]
        for anchor, window, which, scores in _best(anchors, rows, limit, same, readers):
            many = len(which)
            found.append(
                arrow_table(
                    HITS,
                    np.full(many, anchors.rows[anchor]),
                    np.full(many, window),
                    rows.rows[which],
                    rows.ids[which],
                    scores.astype(np.int64),
                )
            )
        return pa.Table.from_batches(found)

    return read


def search(blocks: DataFrame, anchors: DataFrame, limit: int, same: bool) -> DataFrame:
    """For each anchor and window the best ``limit`` rows of its label (``same``) or of others.

    ``anchors`` has arrays ``low`` and ``high`` of the windows' limits. Returns anchor row, number
    of the window, rank, and the row, id and score that were found; the same score goes to the
    smaller id.
    """
    floors = blocks.groupBy("shelf").cogroup(anchors.groupBy("shelf")).applyInArrow(
        _floors(limit, same), "row bigint, low array<bigint>"
    )
    narrowed = written(anchors.drop("low").join(floors, "row"), "narrowed")
    tile = F.floor(F.col("shelf") / TILE).cast("bigint")
    zones = blocks.select("dim", "shelf", "block", "zone_labels", "lows", "highs", tile.alias("tile"))
    groups = narrowed.select(F.col("dim").alias("_dim"), F.col("group").alias("_group")).distinct()
    tiles = zones.select(F.col("dim").alias("_dim"), F.col("tile").alias("_tile")).distinct()
    sought = narrowed.join(tiles, narrowed["dim"] == tiles["_dim"]).groupBy("_dim", "_tile", "group")
    asking = zones.join(groups, zones["dim"] == groups["_dim"]).groupBy("dim", "tile", "_group")
    pairs = written(asking.cogroup(sought).applyInArrow(_needed(same), NEEDED_DDL), "needed")
    fetched = blocks.drop("zone_labels", "lows", "highs").join(pairs.drop("dim"), ["shelf", "block"])
    visits = pairs.select(*[F.col(c).alias(f"_{c}") for c in ("dim", "shelf", "group")]).distinct()
    visited = (narrowed["group"] == visits["_group"]) & (narrowed["dim"] == visits["_dim"])
    readers = narrowed.join(visits, visited).groupBy("_shelf", "_group")
    hits = fetched.groupBy("shelf", "group").cogroup(readers).applyInArrow(_read(limit, same), HITS_DDL)
    best = Window.partitionBy("row", "window").orderBy(F.desc("score"), "other_id", "other_row")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)


def mine(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Rows with a null id, label or vector, an empty vector, or a null, non-finite or huge component
    (beyond ``LARGEST`` over the root of the dimension) take no part. Vectors of different
    dimensions do not meet. Repeated rows are rows: each is an anchor, positive or negative of its
    own. Anchors without positives, and positives without a negative in their window, give no
    rows, nor does an empty table. Other columns are ignored.
    """
    blocks = blocks_of(labelled(vectors))
    anchors = anchors_of(blocks)
    open_ = anchors.withColumns(
        {"low": F.array(F.lit(-NO_LIMIT)), "high": F.array(F.lit(NO_LIMIT))}
    )
    positives = written(search(blocks, open_, POSITIVES, True), "positives")
    windows = positives.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("_found"))

    def limit(percent: int, up: bool) -> Column:
        """The least or greatest whole score that keeps to the share."""

        def of(found: Column) -> Column:
            share = found["score"] * percent
            over = F.pmod(-share if up else share, F.lit(100))
            return F.call_function("div", share + over if up else share - over, F.lit(100))

        return F.transform("_found", of)

    asked = windows.withColumns({"low": limit(LOWEST, True), "high": limit(HIGHEST, False)}).drop("_found")
    negatives = search(blocks, written(anchors.join(asked, "row"), "windows"), NEGATIVES, False)
    named = positives.select(
        "row",
        (F.col("rank") - 1).alias("window"),
        F.col("other_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    ).join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return named.join(negatives, ["row", "window"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


ORACLE = """
WITH rows AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same,
        list_inner_product(a.q, b.q)::BIGINT AS score
    FROM rows a JOIN rows b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, b) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
    row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.id, n.b)::INTEGER AS rank,
    n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.a = p.a AND NOT n.same
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""
