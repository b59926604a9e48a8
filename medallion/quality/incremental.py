"""Checks of what came into a table since they were last run.

A rule is settled if a row that it passed once passes for ever, as long as the row stays as it
is. Such a rule looks only at rows whose version is newer than the one up to which it was
checked, and these are read from the layers of the table that hold them. Other rules, and rules
that are new or have changed, look at all rows, and leave out what is recorded already.

Violations are a by-day table whose days are the dates of the runs. Its entries also say up to
which version each rule was checked, so violations and progress are one commit: a run that dies
has checked nothing, and a date run again replaces what it recorded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.upsert import VERSION, StateTable
from medallion.operators.windows import DayWindow, one_day
from medallion.quality import engine
from medallion.quality.rules import ReferenceRule, RowRule
from medallion.schema import LONG, TEXT, TIME, struct
from medallion.sources import journal, tables

Rule = RowRule | ReferenceRule
CHECK = struct(version=LONG, run_date=TEXT, checked=LONG, rows=LONG)
FOUND = struct(
    rule=TEXT, analyzed_column=TEXT, client_id=LONG, offender=TEXT, rule_params=TEXT
)


def violations(spark: SparkSession, path: str, table: StateTable, carry: Sequence[str] = ("updated_at",)) -> DataFrame:
    """All recorded violations, with the date of the run that recorded them."""
    schema = T.StructType([*_schema(table, carry).fields, T.StructField(tables.DAY, T.StringType())])
    rows = tables.read_days(spark, path, schema, DayWindow())
    return rows.withColumnRenamed(tables.DAY, engine.RUN_DATE)


def checks(spark: SparkSession, path: str) -> DataFrame:
    """The runs so far: date, version of the table they looked at, violations they recorded."""
    return journal.history(spark, f"{path}/{tables.VERSIONS}", CHECK)


def check_changes(
    spark: SparkSession,
    table: StateTable,
    rules: Sequence[Rule],
    path: str,
    run_date: str,
    checked_at: Column | None = None,
    carry: Sequence[str] = ("updated_at",),
) -> int:
    """Record under ``run_date`` (YYYYMMDD) what the rules find that no other date has recorded;
    return the number of violations.

    ``carry`` names the columns that tell versions of a row apart. A date run again looks at the
    rows that it looked at before, as far as they are still as they were, and, if it is the
    latest date, at what has come in meanwhile.
    """
    if not rules:
        raise ValueError("no rules to run")
    before, upto, after, latest = _progress(spark, table, path, run_date)
    fresh: dict[int, list[Rule]] = {}
    whole = []
    for rule in rules:
        since = before.get(_mark(rule), 0) if rule.settled else 0
        (fresh.setdefault(since, []) if since else whole).append(rule)
    parts = [
        engine.run(_upto(table.changed_since(spark, since), upto), chosen, checked_at, table.key, carry)
        for since, chosen in sorted(fresh.items())
        if since < upto
    ]
    if whole:
        found = engine.run(_upto(table.rows(spark), upto), whole, checked_at, table.key, carry)
        known = violations(spark, path, table, carry)
        known = known.where(F.col("rule").isin(*[rule.name for rule in whole]))
        parts.append(engine.not_yet_recorded(found, known, run_date, carry))
    names = [*_schema(table, carry).names, tables.DAY]
    none = spark.createDataFrame([], _schema(table, carry))
    rows = reduce(DataFrame.unionByName, parts, none).withColumn(tables.DAY, F.lit(run_date))
    staged = tables.stage_days(rows.select(*names), path, one_day(run_date))
    now = {_mark(rule): upto for rule in rules if rule.settled}
    after = after | {mark: max(version, after.get(mark, 0)) for mark, version in now.items()}
    staged.commit(run_date=run_date, checked=upto, before=before, after=after, latest=latest)
    return staged.rows


def _schema(table: StateTable, carry: Sequence[str]) -> T.StructType:
    carried = [table.schema[name] for name in carry]
    return T.StructType([*FOUND.fields, *carried, T.StructField("checked_at", T.TimestampType())])


def _upto(rows: DataFrame, version: int) -> DataFrame:
    return rows.where(F.col(VERSION) <= version)


def _mark(rule: Rule) -> str:
    """Tells rules apart, and a rule from one of the same name with other settings."""
    if isinstance(rule, ReferenceRule):
        settings = "/".join([*rule.columns, "=", *rule.reference_columns])
    elif rule.settings is None:
        settings = f"{rule.violated}|{rule.params}"
    else:
        settings = rule.settings
    column = "" if isinstance(rule, ReferenceRule) else rule.column
    return f"{rule.name}:{column}:{hashlib.md5(settings.encode()).hexdigest()}"


def _progress(
    spark: SparkSession, table: StateTable, path: str, run_date: str
) -> tuple[dict[str, int], int, dict[str, int], str]:
    """Up to which version each rule was checked before this date, the version to look at, what
    all runs together have checked, and the latest date."""
    folder, version = f"{path}/{tables.VERSIONS}", table.version(spark)
    newest = journal.newest(spark, folder)
    if newest is None:
        return {}, version, {}, run_date
    after, latest = newest["after"], max(newest["latest"], run_date)
    if run_date > newest["latest"]:
        return after, version, after, latest
    # Only a rerun looks back, and as a rule no farther than the last entry.
    for number in reversed(journal.numbers(spark, folder)):
        entry = journal.entry(spark, folder, number)
        if entry["run_date"] == run_date:
            return entry["before"], version if run_date == latest else entry["checked"], after, latest
    return after, version, after, latest
