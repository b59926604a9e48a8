"""The client quality report and the gold aggregates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.sums import SumTable
from medallion.operators.upsert import StateTable
from medallion.quality import rules
from medallion.quality.engine import check_rows, run
from medallion.schema import BUSINESS_COLUMNS, PERSON_TYPES


def client_rules(
    silver: DataFrame, addresses: DataFrame | None, as_of: date | str | None
) -> list[rules.RowRule | rules.ReferenceRule]:
    """The rules for the silver client table; the phone rule is not among them, since
    silver has no ill-formed phones left."""
    chosen: list[rules.RowRule | rules.ReferenceRule] = [
        rules.required(BUSINESS_COLUMNS),
        rules.category("person_type", PERSON_TYPES),
        rules.negative("income"),
        rules.mean_outlier(silver, "income", 3.0),
        rules.future_date("birth_date", as_of),
        rules.age_range("birth_date", 0, 120, as_of),
    ]
    if addresses is not None:
        chosen.append(rules.ReferenceRule(addresses))
    return chosen


def quality_report(
    silver: DataFrame,
    bronze: DataFrame,
    addresses: DataFrame | None,
    as_of: date | str | None = None,
    checked_at: Column | None = None,
) -> DataFrame:
    """All violations: of silver, and ill-formed phones where they still are, in bronze."""
    stamp = F.current_timestamp() if checked_at is None else checked_at
    found = run(silver, client_rules(silver, addresses, as_of), stamp)
    phones = check_rows(bronze, [rules.pattern("phone")]).withColumn("checked_at", stamp)
    return found.unionByName(phones)


def clients_by_country(silver: DataFrame) -> DataFrame:
    """Clients and income per country and kind of person."""
    # The wide sum holds any number of incomes.
    income = F.sum(F.col("income").cast("decimal(28,2)"))
    return silver.groupBy("country", "person_type").agg(
        F.count(F.lit(1)).alias("clients"), income.alias("income")
    )


def clients_by_country_of(table: StateTable, path: str, living: str = "true") -> SumTable:
    """The same, kept by differences beside a state table whose feed has the columns."""
    income = {"income": ("income", T.DecimalType(28, 2))}
    return SumTable(path, table, ("country", "person_type"), income, living)


def mean_parts_of(table: StateTable, path: str, column: str = "income") -> SumTable:
    """What the mean of a decimal column is made of, kept by differences; see
    ``rules.mean_outlier_of_sums``."""
    parts = {name: (half, T.DecimalType(30, 0)) for name, half in rules.halves(column, table.schema[column].dataType).items()}
    return SumTable(path, table, (), {**parts, "values": (f"IF(`{column}` IS NULL, 0, 1)", T.LongType())})


def violations_by_rule(violations: DataFrame) -> DataFrame:
    return violations.groupBy("rule", "analyzed_column").agg(F.count(F.lit(1)).alias("violations"))
