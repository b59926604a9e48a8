"""Which landing days a run takes in."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "%Y%m%d"
ANY_DIGIT = "[0-9]"


@dataclass(frozen=True)
class DayWindow:
    """Days ``first`` to ``last`` inclusive, or the days ``listed``; none of them means every
    day."""

    first: date | None = None
    last: date | None = None
    listed: tuple[str, ...] | None = None

    @property
    def everything(self) -> bool:
        return self.first is None and self.listed is None

    @property
    def single(self) -> bool:
        return not self.everything and len(self.days()) == 1

    def days(self) -> list[str]:
        if self.listed is not None:
            return sorted(self.listed)
        span = (self.last - self.first).days + 1
        return [(self.first + timedelta(days=n)).strftime(DAY_FORMAT) for n in range(span)]

    def holds(self, load_date: Column) -> Column:
        """Predicate on the bare partition column, so that partitions are pruned."""
        if self.everything:
            return F.lit(True)
        if self.listed is not None:
            return load_date.isin(*self.listed)
        return load_date.between(self.first.strftime(DAY_FORMAT), self.last.strftime(DAY_FORMAT))

    def glob(self) -> str:
        """The part of a folder glob that narrows the file listing to the window's days."""
        return ANY_DIGIT * 8 if self.everything else "{" + ",".join(self.days()) + "}"


def one_day(day: str) -> DayWindow:
    """The window of a single day, given as YYYYMMDD."""
    parsed = datetime.strptime(day, DAY_FORMAT).date()
    return DayWindow(parsed, parsed)


def day_window(mode: str, as_of: date, start_day: str | None = None) -> DayWindow:
    """``d-1``: the day before ``as_of``. ``d-x``: ``start_day`` (YYYYMMDD) up to and with
    ``as_of``. ``full-refresh``: every day there is."""
    if mode == "full-refresh":
        return DayWindow()
    if mode == "d-1":
        yesterday = as_of - timedelta(days=1)
        return DayWindow(yesterday, yesterday)
    if mode == "d-x":
        if start_day is None:
            raise ValueError("mode d-x needs start_day (YYYYMMDD)")
        first = datetime.strptime(start_day, DAY_FORMAT).date()
        if first > as_of:
            raise ValueError(f"start_day {start_day} is after {as_of:%Y%m%d}")
        return DayWindow(first, as_of)
    raise ValueError(f"unknown mode {mode!r}: use d-1, d-x or full-refresh")
