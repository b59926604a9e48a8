"""Ages and reference dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def reference_date(as_of: date | str | None) -> Column:
    """``as_of`` as a date column; today only when the caller names no date."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def months_apart(later: Column, earlier: Column) -> Column:
    """Months between two dates, as the built-in ``months_between`` counts them: whole if
    the days of the month agree or both dates end their month, else a day is 1/31.

    The built-in works on timestamps and converts both sides to the session's time zone
    for each row; on dates this is several times faster.
    """
    whole = (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))
    days = F.dayofmonth(later) - F.dayofmonth(earlier)
    both_end = (later == F.last_day(later)) & (earlier == F.last_day(earlier))
    places = F.lit(1e8)
    partial = F.floor((whole + days / F.lit(31.0)) * places + 0.5) / places
    return F.when((days == 0) | both_end, whole.cast("double")).otherwise(partial)


def fractional_years(birth: Column, as_of: Column) -> Column:
    return months_apart(as_of, birth) / F.lit(12)


def completed_years(birth: Column, as_of: Column) -> Column:
    return F.floor(fractional_years(birth, as_of)).cast("int")


def latest_birth(as_of: Column, years: int) -> Column:
    """The last birth date at which ``years`` are completed by ``as_of``: the same day
    that many years before, but the end of the month if ``as_of`` ends its month."""
    same_day = F.add_months(as_of, -12 * years)
    return F.when(as_of == F.last_day(as_of), F.last_day(same_day)).otherwise(same_day)
