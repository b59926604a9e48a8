"""Near-duplicate embeddings by an exact metric range join.

Unit vectors whose cosine is at least 0.98 are at most ``REACH`` apart. Equal vectors are one
class. The classes of a label are partitioned by their nearest pivot into cells, and cells of more
than ``BLOCK`` vectors into blocks, each of which is at home in one task. A vector is also sent, as
a guest, to the blocks of other cells in which a vector within reach of it may be at home: by the
triangle inequality such a cell's pivot is at most twice the reach farther than its own, and the
plane halfway between the two pivots is at most the reach away. This holds in both directions, so
of two blocks only one sends to the other, and every pair of vectors meets once.

A task holds one block, whatever its guests, and finds pairs in it by pivots again, then by the
first components in a basis of the block: they and the length of the rest bound a cosine from
above. A task returns one count per vector and the edges of a star per connected group, never all
pairs. Vectors are shipped as they were given, packed, and in rounds that each ship about as much
as all classes hold; a round's shuffle is deleted before the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.common import arrow_table, written
from medallion.llm.components import components
from medallion.session import work_folder
from medallion.sources import files

MIN_COSINE = 0.98
REACH = (2 - 2 * MIN_COSINE) ** 0.5
ANGLE = np.arccos(MIN_COSINE)
# Room for rounding: in cosines and distances, and in those of single precision, which
# only ever rule pairs out or in that are far from the limit.
SLACK = 1e-9
DISTANCE_SLACK = 1e-6
FLOAT_SLACK = 1e-4
# Vectors to a pivot, and at home in a task at most, of up to ``DIM`` dimensions; fewer of more.
CELL, BLOCK, DIM = 1 << 17, 3 << 16, 64
# Pivots of all labels together: the driver holds at most twice as many. Where there are more
# vectors, cells are larger and have more blocks.
MAX_PIVOTS = 2_048
# Components that a round ships at least, if there are so many.
ROUND = 1 << 26
# Inside a task: vectors to a pivot, of a piece of a cell, and of guests at a time, of which there
# are fewer if they have more than so many components.
INNER, PIECE, CHUNK, WIDEST = 128, 512, 4_096, 1 << 21
PREFIX = 15
# Rows that are placed at a time, times their components, cells or blocks.
WIDE = 1 << 20
# Spark's setting that deletes the shuffle files of a write when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _unit(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
    odd = (lengths < 1e-150) | (lengths > 1e150)
    if odd.any():
        # Their squares are too large or too small for a number.
        vectors = vectors.copy()
        vectors[odd] /= np.abs(vectors[odd]).max(axis=1)[:, None]
        lengths[odd] = np.sqrt((vectors[odd] * vectors[odd]).sum(axis=1))
    return vectors / lengths[:, None]


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int, kind: str) -> np.ndarray:
    """The packed vectors of a column as rows."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    found = []
    for chunk in chunks:
        size = dim * np.dtype(kind).itemsize
        flat = np.frombuffer(chunk.buffers()[2] or b"", np.uint8)
        first = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset] if len(chunk) else 0
        found.append(flat[first : first + size * len(chunk)].view(kind).reshape(len(chunk), dim))
    return found[0] if len(found) == 1 else np.concatenate(found or [np.empty((0, dim), kind)])


def _packer(kind: str):
    """Packs vectors into bytes; null for rows that cannot link: those without id or label, and
    vectors that are null, empty, zero or not finite. A negative zero becomes a zero."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            lengths = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.dtype(kind).type(0)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            odd, other = (np.concatenate([[0], np.cumsum(x)]) for x in (~np.isfinite(values), values != 0))
            usable = (odd[ends[1:]] == odd[ends[:-1]]) & (other[ends[1:]] > other[ends[:-1]])
            for name in ("vec_id", "label"):
                usable &= batch.column(name).is_valid().to_numpy(zero_copy_only=False)
            places = pa.py_buffer((ends * values.itemsize).astype(np.int32))
            valid = pa.array(usable).buffers()[1]
            packed = pa.Array.from_buffers(pa.binary(), len(usable), [valid, places, pa.py_buffer(values)])
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id"),
                    "label": batch.column("label"),
                    "_dim": pa.array(lengths.astype(np.int32)),
                    "_vector": packed,
                }
            )

    return pack


def _most(rows: int, dim):
    """So many rows of 64 dimensions, in rows of ``dim``."""
    return F.greatest(F.lit(1), F.floor(F.lit(rows * DIM) / F.greatest(dim, F.lit(DIM))))


def pivots(classes: DataFrame, large: DataFrame, count: int, kind: str) -> dict[tuple, np.ndarray]:
    """Unit pivots of each label and dimension in ``large``.

    They are the vectors whose hash is among the first of so many as a cell has, so about one to
    a cell and ``2 * MAX_PIVOTS`` altogether; each task picks its own. A group without any is
    one cell.
    """
    cell = F.greatest(_most(CELL, F.col("_dim")), F.lit(count // MAX_PIVOTS))
    hashed = F.xxhash64("_vector")
    chosen = classes.where(F.pmod(hashed, cell) == 0).join(large, ["label", "_dim"], "left_semi")
    chosen = chosen.withColumn("_rank", hashed)
    found: dict[tuple, list] = {}
    for row in chosen.orderBy("label", "_dim", "_rank").select("label", "_dim", "_vector").collect():
        found.setdefault((row["label"], row["_dim"]), []).append(np.frombuffer(row["_vector"], kind))
    return {key: _unit(np.array(rows, np.float64)) for key, rows in found.items()}


def cells_of(units: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, cells, and whether the row is at home there."""
    squared = np.maximum(2 - 2 * (units @ centres.T), 0)
    home = squared.argmin(axis=1)
    own = squared[np.arange(len(units)), home][:, None]
    apart = np.sqrt(np.maximum(2 - 2 * (centres @ centres.T), 0))[home]
    near = np.sqrt(squared) - np.sqrt(own) <= 2 * REACH + DISTANCE_SLACK
    near &= squared - own <= 2 * REACH * apart + DISTANCE_SLACK
    near[np.arange(len(units)), home] = True
    rows, cells = np.nonzero(near)
    return rows, cells, cells == home[rows]


def _groups(batch: pa.RecordBatch, width: dict[tuple, int]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The rows of each label and dimension of a batch, fewer at a time if many numbers are made of each."""
    labels, dims = batch.column("label").to_numpy(), batch.column("_dim").to_numpy()
    groups, member = np.unique(np.stack([labels, dims]), axis=1, return_inverse=True)
    for number, key in enumerate(groups.T.tolist()):
        rows = np.flatnonzero(member.ravel() == number)
        step = max(1, WIDE // max(key[1], width.get(tuple(key), 1)))
        for start in range(0, len(rows), step):
            yield tuple(key), batch.take(pa.array(rows[start : start + step]))


def _surveyor(centres: dict[tuple, np.ndarray], kind: str):
    """Counts the vectors at home in each cell, and its guests."""

    width = {key: len(found) for key, found in centres.items()}

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, part in _groups(batch, width):
                home, guests = np.array([part.num_rows]), np.array([0])
                if key in centres:
                    units = _unit(_matrix(part.column("_vector"), key[1], kind).astype(np.float64))
                    _, cells, own = cells_of(units, centres[key])
                    home, guests = (np.bincount(cells[x], minlength=len(centres[key])) for x in (own, ~own))
                size = len(home)
                yield arrow_table(
                    SURVEYED, np.full(size, key[0]), np.full(size, key[1]), np.arange(size), home, guests
                )

    return survey


SURVEYED = pa.schema(
    [("label", pa.int32()), ("_dim", pa.int32()), ("_cell", pa.int32()), ("_home", pa.int64()), ("_guests", pa.int64())]
)
# _place: twice the block, and one more for a guest.
PLACED = "label int, _dim int, _place bigint, _node bigint, _copies bigint, _vector binary"


class Plan:
    """The blocks of the cells of all large groups, and the round of each."""

    def __init__(self, centres: dict[tuple, np.ndarray], cells: list, total: int):
        self.centres = centres
        self.first: dict[tuple, np.ndarray] = {}
        self.blocks: dict[tuple, np.ndarray] = {}
        # Rounds are filled up label by label, so that few rounds read a label.
        self.rounds: list[set] = []
        turns, held = [], total
        for label, dim, cell, home, guests in sorted(cells):
            key = label, dim
            if key not in self.first:
                size = len(centres[key]) if key in centres else 1
                self.first[key], self.blocks[key] = np.zeros(size, np.int64), np.zeros(size, np.int64)
            most = max(1, BLOCK * DIM // max(dim, DIM))
            blocks = -(-home // most)
            self.first[key][cell], self.blocks[key][cell] = len(turns), blocks
            for _ in range(blocks):
                # Of its guests a block gets those of about half of the other blocks.
                load = dim * (home // blocks + (guests + home - home // blocks) // 2)
                if held + load > total:
                    self.rounds.append(set())
                    held = 0
                held += load
                self.rounds[-1].add(key)
                turns.append(len(self.rounds) - 1)
        self.turns = np.array(turns, np.int64)

    def places(self, key: tuple, units: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, the blocks they go to, and whether they are at home there."""
        rows = np.arange(len(units))
        cells, own = np.zeros_like(rows), np.ones(len(rows), bool)
        if key in self.centres:
            rows, cells, own = cells_of(units, self.centres[key])
        first, blocks = self.first[key], self.blocks[key]
        cell = np.empty(len(units), np.int64)
        cell[rows[own]] = cells[own]
        mixed = (nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
        mine = first[cell] + mixed % blocks[cell]
        copies = blocks[cells]
        inside = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        rows, to = np.repeat(rows, copies), np.repeat(first[cells], copies) + inside
        mine = mine[rows]
        # Of two blocks the lower sends to the higher if both are even or both odd.
        goes = (to == mine) | ((mine < to) == ((mine + to) % 2 == 0))
        return rows[goes], to[goes], (to == mine)[goes]


def _placer(plan: Plan, turn: int, kind: str):
    width = {key: int(found.sum()) for key, found in plan.blocks.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, part in _groups(batch, width):
                units = _unit(_matrix(part.column("_vector"), key[1], kind).astype(np.float64))
                rows, to, home = plan.places(key, units, part.column("_node").to_numpy())
                now = plan.turns[to] == turn
                rows, place = rows[now], 2 * to[now] + ~home[now]
                for start in range(0, len(rows), batch.num_rows):
                    some = pa.array(rows[start : start + batch.num_rows])
                    columns = {name: part.column(name).take(some) for name in ("label", "_dim", "_node", "_copies", "_vector")}
                    columns["_place"] = pa.array(place[start : start + batch.num_rows])
                    yield pa.RecordBatch.from_pydict({name: columns[name] for name in PLACED_NAMES})

    return place


PLACED_NAMES = [part.split()[0] for part in PLACED.split(",")]
JOINED = pa.schema([("_node", pa.int64()), ("_linked", pa.int64()), ("_other", pa.int64())])


def _chunk(dim: int) -> int:
    return max(1, min(CHUNK, WIDEST // dim))


def _basis(vectors: np.ndarray) -> np.ndarray:
    """Orthonormal columns, along which the vectors differ most; all of few dimensions."""
    dim = vectors.shape[1]
    if dim <= PREFIX:
        return np.eye(dim)
    some = _unit(vectors[:: max(1, len(vectors) // _chunk(dim))].astype(np.float64))
    found = np.random.default_rng(0).normal(size=(dim, PREFIX))
    for _ in range(4):
        found = np.linalg.qr(some.T @ (some @ found))[0]
    return found


class Block:
    """The vectors at home in a task, in order of their nearest pivots, and what they link with."""

    def __init__(self, nodes: np.ndarray, copies: np.ndarray, vectors: np.ndarray):
        self.basis, self.chunk = _basis(vectors), _chunk(vectors.shape[1])
        picked = [0]
        if len(vectors) > 2 * INNER:
            picked = np.random.default_rng(0).choice(len(vectors), len(vectors) // INNER, replace=False)
        centres = _unit(vectors[picked].astype(np.float64))
        self.centres = centres.T.astype(np.float32)
        cell, cosine = np.empty(len(vectors), np.int64), np.empty(len(vectors), np.float32)
        for start in range(0, len(vectors), self.chunk):
            end = start + self.chunk
            found = _unit(vectors[start:end].astype(np.float64)).astype(np.float32) @ self.centres
            cell[start:end] = found.argmax(axis=1)
            cosine[start:end] = found.max(axis=1)
        order = np.argsort(cell, kind="stable")
        self.nodes, self.copies, self.vectors = nodes[order], copies[order], vectors[order]
        cell, cosine = cell[order], cosine[order]
        bounds = np.searchsorted(cell, np.arange(len(picked) + 1))
        self.pieces = [
            (c, a, min(a + PIECE, end))
            for c, (start, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
            for a in range(start, end, PIECE)
        ]
        # What a vector's cosine with a pivot is at least if it is within reach of a member.
        lowest = np.ones(len(picked))
        np.minimum.at(lowest, cell, cosine)
        farthest = np.arccos(np.clip(lowest - FLOAT_SLACK, -1, 1)) + ANGLE
        self.least = (np.cos(np.minimum(farthest, np.pi)) - FLOAT_SLACK).astype(np.float32)
        # By how much less than its cosine with its own pivot.
        apart = 2 - 2 * (centres @ centres.T)
        np.sqrt(np.maximum(apart, 0, out=apart), out=apart)
        self.apart = apart.astype(np.float32)
        self.apart *= REACH + DISTANCE_SLACK
        self.apart += FLOAT_SLACK
        self.prefix = np.concatenate(
            [self._prefix(self._units(a, a + self.chunk)) for a in range(0, len(vectors), self.chunk)]
        )
        self.counts = np.zeros(len(vectors), np.int64)
        self.parent = np.arange(len(vectors))

    def _units(self, start: int, end: int) -> np.ndarray:
        return _unit(self.vectors[start:end].astype(np.float64))

    def _prefix(self, units: np.ndarray) -> np.ndarray:
        """Components along the basis, and the length of the rest: a product of two such rows is
        no less than the cosine."""
        inside = units @ self.basis
        rest = np.sqrt(np.maximum(1 - (inside * inside).sum(axis=1), 0))
        return np.column_stack([inside, rest]).astype(np.float32)

    def meet_itself(self) -> None:
        for start in range(0, len(self.nodes), self.chunk):
            end = start + self.chunk
            units = self._units(start, end)
            anchors = np.arange(start, start + len(units))
            self._meet(units, self.copies[start:end], self.counts[start:end], anchors, start)

    def meet(self, nodes: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        """Counts of guests, and for each that links one at home that it links with."""
        counts, anchors = np.zeros(len(nodes), np.int64), np.full(len(nodes), -1)
        self._meet(_unit(vectors.astype(np.float64)), copies, counts, anchors, None)
        found = np.flatnonzero(counts)
        return arrow_table(JOINED, nodes[found], counts[found], self.nodes[anchors[found]])

    def found(self) -> pa.RecordBatch:
        """Counts of those at home, and stars of their connected groups."""
        roots = self._roots(np.arange(len(self.nodes)))
        least = np.full(len(roots), np.iinfo(np.int64).max)
        np.minimum.at(least, roots, self.nodes)
        some = np.flatnonzero(self.counts)
        other = least[roots[some]]
        other = pa.array(other, mask=other == self.nodes[some])
        return arrow_table(JOINED, self.nodes[some], self.counts[some], other)

    def _meet(self, units, copies, counts, anchors, start: int | None) -> None:
        """Adds the links of some vectors; ``start`` is the place of the first if they are at
        home themselves, and each then meets those after it."""
        single, prefix = units.astype(np.float32), self._prefix(units)
        near = None
        if self.centres.shape[1] > 1:
            cosines = single @ self.centres
            own = cosines.argmax(axis=1)
            limit = self.apart[own]
            np.subtract(cosines[np.arange(len(own)), own][:, None], limit, out=limit)
            np.maximum(limit, self.least, out=limit)
            near = np.ascontiguousarray((cosines >= limit).T)
            del cosines, limit
        last, rows, some = -1, np.arange(len(units)), prefix
        for cell, a, b in self.pieces:
            if start is not None and b <= start:
                continue
            if near is not None and cell != last:
                rows = np.flatnonzero(near[cell])
                some, last = prefix.take(rows, axis=0), cell
            if not len(rows):
                continue
            bounds = some @ self.prefix[a:b].T
            if bounds.max() < MIN_COSINE - FLOAT_SLACK:
                continue
            later = None
            if start is not None and a < start + len(units):
                later = np.arange(a, b) > (start + rows)[:, None]
            self._link(rows, a, b, bounds, later, units, single, copies, counts, anchors)

    def _link(self, rows, a, b, bounds, later, units, single, copies, counts, anchors) -> None:
        maybe = bounds >= MIN_COSINE - FLOAT_SLACK
        if later is not None:
            maybe &= later
        number = np.count_nonzero(maybe)
        if not number:
            return
        if 16 * number < maybe.size:
            i, j = _places(maybe)
            linked = _linked(units, self.vectors, rows[i], a + j)
            i, j = rows[i[linked]], j[linked]
            np.add.at(counts, i, self.copies[a + j])
            np.add.at(self.counts, a + j, copies[i])
            new = anchors[i] < 0
            anchors[i[new]] = a + j[new]
            self._unite(anchors[i], a + j)
            return
        cosines = single[rows] @ self._units(a, b).astype(np.float32).T
        linked = maybe & (cosines >= MIN_COSINE)
        cosines -= MIN_COSINE
        maybe &= np.abs(cosines, out=cosines) < FLOAT_SLACK
        i, j = _places(maybe)
        linked[i, j] = _linked(units, self.vectors, rows[i], a + j)
        weights = linked.astype(np.float64)
        counts[rows] += (weights @ self.copies[a:b]).astype(np.int64)
        self.counts[a:b] += (copies[rows] @ weights).astype(np.int64)
        first = linked.argmax(axis=1)
        new = (anchors[rows] < 0) & linked[np.arange(len(rows)), first]
        anchors[rows[new]] = a + first[new]
        while True:
            here, there = self._roots(np.maximum(anchors[rows], 0)), self._roots(np.arange(a, b))
            if len(there) and here.min() == here.max() == there.min() == there.max():
                return
            differ = linked & (here[:, None] != there)
            i, j = np.flatnonzero(differ.any(axis=1)), np.flatnonzero(differ.any(axis=0))
            if not len(i):
                return
            # Each group on either side grows in every turn.
            left, right = anchors[rows[i]], a + differ[i].argmax(axis=1)
            other = anchors[rows[differ[:, j].argmax(axis=0)]]
            self._unite(np.concatenate([left, other]), np.concatenate([right, a + j]))

    def _roots(self, at: np.ndarray) -> np.ndarray:
        roots = self.parent[at]
        while True:
            above = self.parent[roots]
            if (above == roots).all():
                break
            roots = above
        self.parent[at] = roots
        return roots

    def _unite(self, left: np.ndarray, right: np.ndarray) -> None:
        while True:
            left, right = self._roots(left), self._roots(right)
            differ = left != right
            if not differ.any():
                return
            left, right = left[differ], right[differ]
            np.minimum.at(self.parent, np.maximum(left, right), np.minimum(left, right))


def _places(true: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of what is true, which is little; much faster than of a matrix."""
    return np.divmod(np.flatnonzero(true.ravel()), true.shape[1])


def _linked(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of units on the left and vectors on the right reach the cosine; close calls are
    decided by a sum without rounding steps."""
    linked = np.empty(len(i), bool)
    step = max(1, (1 << 21) // left.shape[1])
    for start in range(0, len(i), step):
        some, other = left[i[start : start + step]], _unit(right[j[start : start + step]].astype(np.float64))
        cosines = (some * other).sum(axis=1)
        found = cosines >= MIN_COSINE
        for k in np.flatnonzero(np.abs(cosines - MIN_COSINE) < SLACK):
            found[k] = (some[k].astype(np.longdouble) * other[k]).sum() >= MIN_COSINE
        linked[start : start + step] = found
    return linked


def _joiner(kind: str):
    """Joins blocks with their guests, which come sorted: a block's own vectors first."""

    def arrays(held: list[pa.RecordBatch], dim: int) -> tuple:
        rows = pa.Table.from_batches(held)
        return rows.column("_node").to_numpy(), rows.column("_copies").to_numpy(), _matrix(rows.column("_vector"), dim, kind)

    def meeting(dim: int, block: Block | None, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if block is not None and held:
            yield block.meet(*arrays(held, dim))

    def at_home(dim: int, held: list[pa.RecordBatch], guests: bool) -> Block | None:
        if not held or (not guests and sum(x.num_rows for x in held) == 1):
            return None
        rows = arrays(held, dim)
        # The block has a copy of its own, and is large.
        held.clear()
        block = Block(*rows)
        del rows
        block.meet_itself()
        return block

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, block, held, guests = None, None, [], False
        for batch in batches:
            keys = np.stack([batch.column(name).to_numpy().astype(np.int64) for name in ("label", "_dim", "_place")])
            starts = np.concatenate([[0], 1 + np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)), [batch.num_rows]])
            for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                label, dim, place = keys[:, start].tolist()
                if unit != (label, dim, place >> 1):
                    yield from finished(unit, block, held, guests)
                    unit, block, held, guests = (label, dim, place >> 1), None, [], False
                if place & 1 and not guests:
                    block, held, guests = at_home(dim, held, True), [], True
                held.append(batch.slice(start, end - start))
                if guests and sum(x.num_rows for x in held) >= _chunk(dim):
                    yield from meeting(dim, block, held)
                    held = []
        yield from finished(unit, block, held, guests)

    def finished(unit, block, held, guests) -> Iterator[pa.RecordBatch]:
        if unit is None:
            return
        if guests:
            yield from meeting(unit[1], block, held)
        else:
            block = at_home(unit[1], held, False)
        if block is not None:
            yield block.found()

    return join


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files are deleted when the write that made them ends."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def _joined(classes: DataFrame, kind: str) -> DataFrame:
    """_node, _linked, _other: parts of the number of links of a node, and edges."""
    spark = classes.sparkSession
    count, total = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum("_dim"), F.lit(0))).first()
    total = max(total, ROUND)
    sizes = classes.groupBy("label", "_dim").agg(F.count("*").alias("_size"))
    large = sizes.where(F.col("_size") > F.greatest(_most(CELL, F.col("_dim")), F.lit(1)))
    large = written(large.select("label", "_dim"), "large")
    plan = Plan({}, [], total)
    if not large.isEmpty():
        centres = pivots(classes, large, count, kind)
        schema = "label int, _dim int, _cell int, _home bigint, _guests bigint"
        cells = classes.join(large, ["label", "_dim"], "left_semi").select("label", "_dim", "_vector")
        cells = cells.mapInArrow(_surveyor(centres, kind), schema).groupBy("label", "_dim", "_cell")
        cells = cells.agg(F.sum("_home"), F.sum("_guests")).collect()
        plan = Plan(centres, [tuple(row) for row in cells], total)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = work_folder(spark, "joined")
    schema = "_node bigint, _linked bigint, _other bigint"

    def add(placed: DataFrame) -> None:
        placed.mapInArrow(_joiner(kind), schema).write.mode("append").parquet(folder)

    # A group of no more than a cell is one block without guests.
    small = classes.join(large, ["label", "_dim"], "left_anti").withColumn("_place", F.lit(0).cast("bigint"))
    small = small.select(*PLACED_NAMES).repartition(partitions, "label", "_dim")
    add(small.sortWithinPartitions("label", "_dim"))
    for turn, keys in enumerate(plan.rounds):
        here = spark.createDataFrame(sorted(keys), "label int, _dim int")
        rows = classes.join(F.broadcast(here), ["label", "_dim"], "left_semi").select("label", "_dim", "_node", "_copies", "_vector")
        placed = rows.mapInArrow(_placer(plan, turn, kind), PLACED)
        blocks = int((plan.turns == turn).sum())
        placed = placed.repartition(max(partitions, 2 * blocks), F.shiftright("_place", 1))
        add(placed.sortWithinPartitions("_place"))
    return spark.read.schema(schema).parquet(folder)


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of ``vectors``.

    Vectors link if their labels are equal and their cosine, in double precision, is at least
    0.98. Those that are null, empty or zero, hold a null or non-finite component, or have no
    label or vec_id, link with nothing and are their own component; so do vectors of different
    dimensions with one another. Rows are vectors: repeated rows link with each other, and rows of
    one id with different vectors are told apart. Other columns are ignored; an empty table gives no rows.
    """
    with _cleaned(vectors.sparkSession):
        return _near_duplicates(vectors)


def _near_duplicates(vectors: DataFrame) -> DataFrame:
    spark = vectors.sparkSession
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    kind = "float32" if single else "float64"
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("int").alias("label"),
        F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"),
    ).mapInArrow(_packer(kind), "vec_id bigint, label int, _dim int, _vector binary")
    classes = rows.where("_vector is not null").groupBy("label", "_dim", "_vector").agg(
        F.min("vec_id").alias("_first"), F.count("*").alias("_copies")
    )
    # A class has a number of its own: rows of one id may have different vectors. By its two
    # hashes, 128 bits together, rows find it without their vectors being shipped again.
    hashes = {"_key": F.xxhash64("label", "_vector"), "_second": F.xxhash64(F.lit(1), "_vector", "label")}
    classes = classes.withColumns({"_node": F.monotonically_increasing_id(), **hashes})
    path = work_folder(spark, "classes")
    classes.write.option("parquet.enable.dictionary", "false").parquet(path)
    classes = spark.read.schema(classes.schema).parquet(path)
    joined = _joined(classes, kind)
    counts = joined.groupBy("_node").agg(F.sum("_linked").alias("_linked"))
    edges = joined.where("_other is not null").select(F.col("_node").alias("a"), F.col("_other").alias("b"))
    reached = components(edges).select(F.col("node").alias("_node"), "component")
    members = written(reached.join(classes.select("_node", "_first"), "_node"), "members")
    named = members.groupBy("component").agg(F.min("_first").alias("_smallest"))
    reached = members.join(named, "component").select("_node", "_smallest")
    # Other classes are one row each, without links.
    result = classes.join(counts, "_node", "left").join(reached, "_node", "left")
    result = result.where("_copies > 1 or _linked is not null").select(
        "_key",
        "_second",
        (F.coalesce("_linked", F.lit(0)) + F.col("_copies") - 1).alias("n_links"),
        F.coalesce("_smallest", "_first").alias("component_id"),
    )
    result = written(result, "result")
    files.delete(spark, path)
    named = rows.select("vec_id", F.col("_vector").isNotNull().alias("_usable"), *(x.alias(name) for name, x in hashes.items()))
    named = named.withColumns({name: F.when(F.col("_usable"), F.col(name)) for name in hashes}).drop("_usable")
    component = F.coalesce("component_id", "vec_id")
    return named.join(result, ["_key", "_second"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


ORACLE = """
WITH RECURSIVE vectors AS (
    SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), pairs AS (
    SELECT a.r AS a, b.r AS b FROM vectors a JOIN vectors b ON a.label = b.label AND a.r <> b.r
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reached AS (
    SELECT r AS a, r AS b FROM vectors
    UNION
    SELECT reached.a, pairs.b FROM reached JOIN pairs ON reached.b = pairs.a
), components AS (
    SELECT a, min(vec_id) AS component_id FROM reached JOIN vectors ON r = b GROUP BY a
), counts AS (
    SELECT a, count(*) AS n_links FROM pairs GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN components ON components.a = r LEFT JOIN counts ON counts.a = r
"""
