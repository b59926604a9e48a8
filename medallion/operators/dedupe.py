"""Exact duplicates and latest versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.session import work_folder

HASH = "_identity"
# Hashes of copies up to which only the copies are shuffled; a broadcast of them is small.
FEW = 1_000_000


def distinct_events(
    df: DataFrame, identity: Sequence[str], lineage: Sequence[str] = ("source_file",)
) -> DataFrame:
    """One row per distinct ``identity``, with the smallest lineage values of its copies.

    Copies are merged inside each map task first, so a group that makes up a third of
    the input reaches the shuffle as one row per task.
    """
    kept = [F.min(name).alias(name) for name in lineage]
    if not kept:
        return df.select(*identity).distinct()
    return df.groupBy(*identity).agg(*kept)


def distinct_stored(
    df: DataFrame, identity: Sequence[str], lineage: Sequence[str] = ("source_file",)
) -> DataFrame:
    """The same rows as ``distinct_events``, of a table that is cheap to read again.

    Copies have the same hash, so a first pass shuffles one number per row instead of all
    columns, and only rows whose hash occurs again are compared in full. The others stay where
    they lie. Where copies are more than ``FEW``, all rows are compared at once.
    """
    hashed = df.withColumn(HASH, F.xxhash64(*identity))
    again = hashed.groupBy(HASH).agg(F.count("*").alias("_times")).where("_times > 1").select(HASH)
    path = work_folder(df.sparkSession, "again")
    again.write.parquet(path)
    again = df.sparkSession.read.schema(again.schema).parquet(path)
    many = again.count()
    if many > FEW:
        return distinct_events(df, identity, lineage)
    columns = [*identity, *lineage]
    if not many:
        return df.select(*columns)
    copies = distinct_events(hashed.join(again, HASH, "left_semi"), identity, lineage)
    return hashed.join(again, HASH, "left_anti").select(*columns).unionByName(copies)


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The newest row of each key; ``order`` columns are compared descending, nulls last.

    Kept as ``row_number() = 1`` because Spark then drops all but the first row per key
    in each map task (WindowGroupLimit) before it shuffles: a hot key costs one row per
    task, not all of its rows.
    """
    newest_first = Window.partitionBy(key).orderBy(*[F.desc_nulls_last(name) for name in order])
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )
