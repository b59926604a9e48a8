"""Stable numbering of rows by counting: what a counting-sort pass is made of.

Rows lie in blocks and have an order inside their block. A table of counts per key and block,
summed up over the blocks of each key, tells where a key's rows of a block begin; a row's number
among the key's rows of its own block is added to that. Only counts cross blocks, so that a key
that holds any share of all rows is numbered by as many tasks as it has blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows a task numbers at most for one key, where blocks are cut by place.
BLOCK_ROWS = 1 << 16
DIGIT_BITS = 13


def block_of_row_id(row_id: str):
    """The partition in which ``monotonically_increasing_id`` gave the id."""
    return F.shiftright(row_id, 33)


def numbered(rows: DataFrame, key: str, block: str, place: str, name: str) -> DataFrame:
    """``rows`` with the number of each among the rows of its key, from 0, in order of block and
    place, which together are unique."""
    counts = rows.groupBy(key, block).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    counts = counts.select(key, block, before)
    inside = F.row_number().over(Window.partitionBy(key, block).orderBy(place)) - 1
    both = rows.withColumn("_inside", inside).join(counts, [key, block])
    return both.select(*rows.columns, (F.col("_before") + F.col("_inside")).alias(name))


def counting_pass(rows: DataFrame, digit: str, block: str, place: str) -> DataFrame:
    """``rows`` with new blocks and places: a stable sort by ``digit``, which has few values."""
    totals = rows.groupBy(digit).agg(F.count(F.lit(1)).alias("_n"))
    smaller = Window.orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
    # One row for each value of the digit.
    begin = F.coalesce(F.sum("_n").over(smaller), F.lit(0)).alias("_begin")
    begins = totals.select(digit, begin)
    kept = [c for c in rows.columns if c not in (digit, block, place)]
    joined = numbered(rows, digit, block, place, "_number").join(F.broadcast(begins), digit)
    to = F.col("_begin") + F.col("_number")
    return joined.select(*kept, to.alias(place)).withColumn(
        block, F.floor(F.col(place) / BLOCK_ROWS).cast("bigint")
    )


def digits(fields: list[tuple], width: int = DIGIT_BITS) -> list:
    """The digits of a composite key, least significant first.

    ``fields`` are (column, bits), most significant first: columns of whole numbers from 0 that
    need so many bits. A digit may hold bits of several fields.
    """
    placed, total = [], 0
    for column, bits in reversed(fields):
        placed.append((column, total, total + bits))
        total += bits
    found = []
    for low in range(0, total, width):
        high = min(low + width, total)
        digit = F.lit(0).cast("bigint")
        for column, first, end in placed:
            a, b = max(low, first), min(high, end)
            if a < b:
                part = F.shiftrightunsigned(column, a - first).bitwiseAND(F.lit((1 << (b - a)) - 1))
                digit = digit.bitwiseOR(F.shiftleft(part, a - low))
        found.append(digit)
    return found


def field(column, low: int, high: int) -> tuple:
    """A column of values from ``low`` to ``high`` as a field of a composite key."""
    if high - low < 1 << 63:
        return column - F.lit(low), (high - low).bit_length()
    # The difference is too large for a bigint; with its sign bit turned the value itself has
    # the order of an unsigned number.
    return column.bitwiseXOR(F.lit(-(1 << 63))), 64
