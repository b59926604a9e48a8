"""Runs rules over a table and records what they find."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.quality.rules import ReferenceRule, RowRule
from medallion.sources import tables

RUN_DATE = "run_date"


def check_rows(
    df: DataFrame, rules: Sequence[RowRule], key: str = "client_id", carry: Sequence[str] = ()
) -> DataFrame:
    """One violation per row and broken rule, from a single scan of ``df``.

    Clean rows are filtered out first, so only offenders are expanded. ``carry`` names
    further columns to keep.
    """
    if not rules:
        raise ValueError("no rules to run")
    findings = [
        F.when(
            rule.violated,
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.column).alias("analyzed_column"),
                rule.offender.alias("offender"),
                rule.params.alias("rule_params"),
            ),
        )
        for rule in rules
    ]
    any_broken = reduce(or_, (rule.violated for rule in rules))
    return (
        df.where(any_broken)
        .select(F.col(key).alias("client_id"), *carry, F.inline(F.array(*findings)))
        .where(F.col("rule").isNotNull())
        .select("rule", "analyzed_column", "client_id", "offender", "rule_params", *carry)
    )


def write_reference(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Load a reference table: each complete combination of the columns once."""
    df.select(*columns).na.drop().distinct().write.mode("overwrite").parquet(path)


def check_reference(
    df: DataFrame, rule: ReferenceRule, key: str = "client_id", carry: Sequence[str] = ()
) -> DataFrame:
    """Rows whose value combination the reference lacks; a null part is never found.

    Only key and compared columns are shuffled. Spark broadcasts the reference when its
    size allows, and otherwise splits a hot combination over several tasks. It can do so
    only if both sides come straight from their shuffle, so the reference must not be
    made distinct here: copies in it change no result (see ``write_reference``).
    """
    columns = list(rule.columns)
    rows = df.select(F.col(key).alias("client_id"), *carry, *columns)
    names = list(rule.reference_columns or columns)
    known = rule.reference.select(
        *[F.col(there).alias(here) for here, there in zip(columns, names, strict=True)]
    )
    return rows.join(known, columns, "left_anti").select(
        F.lit(rule.name).alias("rule"),
        F.lit("/".join(columns)).alias("analyzed_column"),
        "client_id",
        F.concat_ws(" | ", *columns).alias("offender"),
        F.lit("{}").alias("rule_params"),
        *carry,
    )


def run(
    df: DataFrame,
    rules: Sequence[RowRule | ReferenceRule],
    checked_at: Column | None = None,
    key: str = "client_id",
    carry: Sequence[str] = (),
) -> DataFrame:
    """All violations of the rules: one pass for the row rules, one join per reference."""
    if not rules:
        raise ValueError("no rules to run")
    row_rules = [rule for rule in rules if isinstance(rule, RowRule)]
    parts = [check_rows(df, row_rules, key, carry)] if row_rules else []
    parts += [
        check_reference(df, rule, key, carry) for rule in rules if isinstance(rule, ReferenceRule)
    ]
    found = reduce(DataFrame.unionByName, parts)
    stamp = F.current_timestamp() if checked_at is None else checked_at
    return found.withColumn("checked_at", stamp)


def not_yet_recorded(
    found: DataFrame,
    recorded: DataFrame,
    run_date: str,
    version: str | Sequence[str] = "updated_at",
    key: str = "client_id",
) -> DataFrame:
    """Violations that no other run has recorded for the same client, version and rule.

    What the run's own date holds is left out, so that a run made again finds and records all
    of it again. Null versions are equal to each other.
    """
    names = [key, *([version] if isinstance(version, str) else version), "rule"]
    others = recorded.where(F.col(RUN_DATE) != run_date)
    known = others.select(*[F.col(name).alias(f"_{name}") for name in names])
    same = reduce(and_, (F.col(name).eqNullSafe(F.col(f"_{name}")) for name in names))
    return found.join(known, same, "left_anti")


def record(violations: DataFrame, path: str, run_date: str) -> None:
    """Keep violations under the run's date; a rerun replaces that run's."""
    violations.write.mode("overwrite").parquet(f"{path}/{RUN_DATE}={run_date}")


def recorded(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Violations of all runs, with ``run_date``; ``schema`` is that of the violations."""
    dated = T.StructType(schema.fields + [T.StructField(RUN_DATE, T.StringType())])
    return tables.read_or_empty(spark, path, dated)
