"""Change events (insert, update, delete) against current state."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.operators.dedupe import latest_per_key
from medallion.operators.upsert import StateTable, purge

DELETE = "D"


def with_tombstones(changes: DataFrame, op: str = "op") -> DataFrame:
    """Replace the operation column by ``deleted``. A deleted client keeps its row, so
    that an older update that comes in late cannot bring it back."""
    return changes.withColumn("deleted", F.coalesce(F.col(op) == DELETE, F.lit(False))).drop(op)


def living(state: DataFrame) -> DataFrame:
    return state.where(~F.col("deleted")).drop("deleted")


def purge_tombstones(
    spark: SparkSession, table: StateTable, as_of: date, days: int, batch_id: str, run_ts: Column
) -> DataFrame:
    """Forget clients deleted more than ``days`` before ``as_of``, and return the audit row.

    The number of days is the bound on lateness: a late update within it finds the tombstone and
    does not revive its client; an event from before it is not taken in any more, and is kept
    with its reason (``upsert.late_events``).
    """
    horizon = datetime.combine(as_of - timedelta(days=days), time())
    return purge(spark, table, "deleted", horizon, batch_id, run_ts)


def apply_changes(
    changes: DataFrame,
    key: str = "client_id",
    order: Sequence[str] = ("updated_at", "event_id"),
    op: str = "op",
) -> DataFrame:
    """Current state after a whole change log."""
    return living(latest_per_key(with_tombstones(changes, op), key, order))
