"""Data-quality rules.

A row rule looks at one row; all row rules of a run share one scan. The mean rule is a
row rule too: its threshold is a scalar subquery. Only the address rule needs a join.
Nulls break no rule but the null rule: a comparison with null is unknown, not true.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.dates import completed_years, latest_birth, reference_date
from medallion.functions.phones import AREA_CODES, area_code, digit_variety
from medallion.schema import LENIENT_PHONE


# The mean rule adds up decimals in two halves of so many digits.
HALF_DIGITS = 19
HALF = Decimal(10) ** HALF_DIGITS
# The names of the rules.
CATEGORY, NEGATIVE, FUTURE = "categorical_domain", "negative_salary", "birth_future_date"
NULLS, PHONE, AGE = "nulls_required", "phone_pattern", "birth_incoherent_age"
MEAN, ADDRESS, PHONE_EXTRA = "salary_discrepant_mean", "address_not_found", "phone_extra"


@dataclass(frozen=True)
class RowRule:
    """``violated`` decides, ``offender`` is the value shown, ``params`` a JSON text of
    the rule's settings with sorted keys. A rule is ``settled`` if a row that it passed once
    passes for ever, whatever other rows and the date become. ``settings`` tells rules of one
    name and column apart, by default by what decides and is shown."""

    name: str
    column: str
    violated: Column
    offender: Column
    params: Column
    settled: bool = True
    settings: str | None = None


def _params(**settings) -> Column:
    return F.lit(json.dumps(settings, sort_keys=True, separators=(",", ":")))


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def category(column: str, allowed: Sequence[str]) -> RowRule:
    """Value not in the allowed list. An empty list allows nothing, null included."""
    violated = ~F.col(column).isin(*allowed) if allowed else F.lit(True)
    return RowRule(
        CATEGORY, column, violated, _text(column), _params(allowed=list(allowed))
    )


def negative(column: str = "income") -> RowRule:
    return RowRule(NEGATIVE, column, F.col(column) < 0, _text(column), _params())


def future_date(column: str = "birth_date", as_of: date | str | None = None) -> RowRule:
    violated = F.col(column) > reference_date(as_of)
    # Settled although the date goes on: what is not in the future will not be.
    return RowRule(FUTURE, column, violated, _text(column), _params(), settings="")


def required(columns: Sequence[str]) -> RowRule:
    """At least one of the columns is null: one violation per row, which lists them."""
    nulls = [F.col(name).isNull() for name in columns]
    violated = reduce(or_, nulls, F.lit(False))
    listed = F.concat_ws(
        '","', *[F.when(null, name) for null, name in zip(nulls, columns, strict=True)]
    )
    params = F.concat(F.lit('{"null":["'), listed, F.lit('"]}'))
    return RowRule(
        NULLS, ",".join(columns), violated, F.lit(None).cast("string"), params
    )


def pattern(column: str = "phone", regex: str = LENIENT_PHONE) -> RowRule:
    violated = ~F.col(column).rlike(regex)
    return RowRule(PHONE, column, violated, _text(column), _params(pattern=regex))


def age_range(
    column: str = "birth_date",
    min_age: int = 18,
    max_age: int = 120,
    as_of: date | str | None = None,
) -> RowRule:
    """Completed years outside the range. A birth after ``as_of`` has a negative age, so
    it is out of any range that starts at 0 or above.

    The range is turned into two dates that are constants of the plan, so rows are
    compared with those, in the scan already, and an age is worked out for offenders only.
    """
    birth, today = F.col(column), reference_date(as_of)
    age = completed_years(birth, today)
    params = F.concat(
        F.lit('{"age":'), age.cast("string"), F.lit(f',"max":{max_age},"min":{min_age}}}')
    )
    violated = (birth > latest_birth(today, min_age)) | (birth <= latest_birth(today, max_age + 1))
    return RowRule(AGE, column, violated, _text(column), params, settled=False)


def phone_extra(
    column: str = "phone",
    area_codes: Sequence[str] = AREA_CODES,
    min_digits: int = 3,
    regex: str = LENIENT_PHONE,
) -> RowRule:
    """A well-formed phone with an unknown area code or too few different digits."""
    phone = F.col(column)
    unknown = ~area_code(phone).isin(*area_codes)
    violated = phone.rlike(regex) & (unknown | (digit_variety(phone) < min_digits))
    params = F.concat(
        F.lit('{"area_code":"'),
        area_code(phone),
        F.lit('","digits":'),
        digit_variety(phone).cast("string"),
        F.lit("}"),
    )
    return RowRule(PHONE_EXTRA, column, violated, phone, params)


def mean_outlier(df: DataFrame, column: str = "income", multiplier: float = 3.0) -> RowRule:
    """Value above ``multiplier`` times the mean of ``df``.

    The limit is a one-value subquery over the column alone: it never passes through the
    driver, and has the column's type, so that the filter on it reaches the scan. For a
    decimal column of any width it is exact, for other types an average.
    """
    value = F.col(column)
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        high, low = (F.expr(half) for half in halves(column, kind).values())
        limit = df.select(_lowest_above_mean(F.sum(high), F.sum(low), F.count(value), kind, multiplier))
        return _above(column, limit.scalar(), kind, multiplier)
    threshold = df.select(F.avg(value) * F.lit(multiplier)).scalar()
    return RowRule(
        MEAN, column, value > threshold, _text(column), _mean_params(multiplier, threshold), settled=False
    )


def mean_outlier_of_sums(
    sums: DataFrame, column: str, kind: T.DecimalType, multiplier: float = 3.0
) -> RowRule:
    """The same rule, to the last place, from sums that are kept beside the table.

    ``sums`` has at most one row, with the sums of the two ``halves`` of the column and the
    number of its values, under the names that ``halves`` gives them and ``values``.
    """
    # The types that sums of the halves have.
    sizes = ("decimal(30,0)", "decimal(29,0)")
    high, low = (F.sum(h).cast(s) for h, s in zip(halves(column, kind), sizes, strict=True))
    limit = sums.select(_lowest_above_mean(high, low, F.sum("values"), kind, multiplier))
    return _above(column, limit.scalar(), kind, multiplier)


def _above(column: str, limit: Column, kind: T.DecimalType, multiplier: float) -> RowRule:
    params = _mean_params(multiplier, limit - F.lit(_unit(kind)))
    return RowRule(MEAN, column, F.col(column) >= limit, _text(column), params, settled=False)


def _mean_params(multiplier: float, threshold: Column) -> Column:
    return F.concat(
        F.lit(f'{{"multiplier":{multiplier},"threshold":"'), threshold.cast("string"), F.lit('"}')
    )


def _unit(kind: T.DecimalType) -> Decimal:
    return Decimal(1).scaleb(-kind.scale)


def halves(column: str, kind: T.DecimalType) -> dict[str, str]:
    """Expressions for a decimal in units of its last place, in two halves of 19 digits: their
    sums are exact, however many there are."""
    if kind.scale > HALF_DIGITS:
        raise ValueError(f"a decimal may have at most {HALF_DIGITS} places: {kind.simpleString()}")
    step, unit = 10 ** (HALF_DIGITS - kind.scale), 10**kind.scale
    # Cut towards zero, as the halves of a negative number are both negative then.
    whole = f"CAST(IF(`{column}` < 0, ceil(`{column}`), floor(`{column}`)) AS DECIMAL(38,0))"
    below = f"({whole} % {step}BD)"
    places = f"CAST(`{column}` - {whole} AS DECIMAL({kind.scale + 1},{kind.scale}))"
    return {
        f"{column}_high": f"CAST(({whole} - {below}) / {step}BD AS DECIMAL(20,0))",
        f"{column}_low": f"CAST({below} * {unit}BD + {places} * {unit}BD AS DECIMAL(19,0))",
    }


def _lowest_above_mean(
    high: Column, low: Column, values: Column, kind: T.DecimalType, multiplier: float
) -> Column:
    """The smallest number of the column's type above the mean times ``multiplier``; null,
    which nothing reaches, if the type has none. Worked out from the sums of the ``halves`` and
    the number of values by a long division, which is exact."""
    factor = Decimal(str(multiplier))
    divisor = 10 ** max(0, -factor.as_tuple().exponent)
    times = F.lit(Decimal(int(factor * divisor)))
    rows = (F.nullif(values, F.lit(0)) * divisor).cast("decimal(18,0)")
    highs, lows = high * times, low * times
    upper = _floor_of_quotient(highs, rows)
    rest = (highs - upper * rows).cast("decimal(18,0)") * F.lit(HALF) + lows
    lower = _floor_of_quotient(rest, rows) + 1
    smallest = F.lit(Decimal(1 - 10**kind.precision))
    lowest = F.try_add(F.try_multiply(upper, F.lit(HALF)), lower)
    lowest = F.when(upper < -HALF, smallest).otherwise(F.greatest(lowest, smallest))
    in_units = F.when(upper < HALF, lowest).try_cast(T.DecimalType(kind.precision, 0))
    return (in_units * F.lit(_unit(kind))).cast(kind)


def _floor_of_quotient(dividend: Column, divisor: Column) -> Column:
    # The quotient is rounded, so it may be one too high; multiplication is exact.
    rounded = (dividend / divisor).cast("decimal(24,0)")
    return F.when(rounded * divisor > dividend, rounded - 1).otherwise(rounded)


@dataclass(frozen=True)
class ReferenceRule:
    """The combination of ``columns`` must occur in ``reference``, where the columns have the
    names in ``reference_columns``, or the same ones. It is ``settled`` if nothing ever leaves
    the reference."""

    reference: DataFrame
    columns: Sequence[str] = ("country", "city", "street", "house_no")
    name: str = ADDRESS
    reference_columns: Sequence[str] = ()
    settled: bool = False
