"""Phone number expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from medallion.schema import STRICT_PHONE

# Two-digit telephone area codes in use in Brazil.
AREA_CODES = tuple(
    "11 12 13 14 15 16 17 18 19 21 22 24 27 28 31 32 33 34 35 37 38 41 42 43 44 45 46 47 48 49 "
    "51 53 54 55 61 62 63 64 65 66 67 68 69 71 73 74 75 77 79 81 82 83 84 85 86 87 88 89 "
    "91 92 93 94 95 96 97 98 99".split()
)


def null_unless(column: Column, pattern: str = STRICT_PHONE) -> Column:
    """The value where it matches the pattern, else null."""
    return F.when(column.rlike(pattern), column)


def area_code(column: Column) -> Column:
    return F.regexp_extract(column, r"\A\((\d{2})\)", 1)


def digit_variety(column: Column) -> Column:
    """How many different digits occur."""
    return reduce(add, (column.contains(str(d)).cast("int") for d in range(10)))
