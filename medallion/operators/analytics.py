"""Questions asked of the trail and of silver."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions.dates import fractional_years, reference_date


def most_updated_clients(
    df: DataFrame, key: str = "client_id", n: int = 5, distinct_on: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` keys with the most rows, ties by key. ``distinct_on`` names the columns
    that make two rows the same event; copies are then counted once."""
    events = df.select(*distinct_on).distinct() if distinct_on else df
    return (
        events.groupBy(key)
        .agg(F.count(F.lit(1)).alias("updates"))
        .orderBy(F.desc("updates"), F.asc(key))
        .limit(n)
    )


def average_age(
    df: DataFrame, birth: str = "birth_date", as_of: date | str | None = None
) -> DataFrame:
    """Mean age in years over the rows given: events of a trail, or clients of silver.

    A text column is read as a date; text that is no date counts as unknown.
    """
    born = F.col(birth)
    if df.schema[birth].dataType.simpleString() == "string":
        born = F.try_to_date(born)
    age = fractional_years(born, reference_date(as_of))
    return df.select(F.avg(age).alias("avg_age_years"))
