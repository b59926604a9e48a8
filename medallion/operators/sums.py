"""Sums over a state table, kept by differences.

A batch that changes rows of a state table leaves a feed: the columns that the sums need, of each
changed row before and after. A row that was there before is taken off the sums of its old group
and put on those of its new one, so the stored sums are brought up to date from the feed alone and
the table is not read. They are whole numbers and decimals, so nothing is lost by adding and
taking off. One entry names the stored sums and the version of the table that they are of: a
batch is added once, however often a run is made again.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.upsert import KEEPS_ROWS, StateTable
from medallion.sources import files, journal, tables

ROWS = "_rows"


@dataclass(frozen=True)
class SumTable:
    """Per group of ``by`` the number of rows and the sums of ``sums``, over the rows of
    ``table`` that fulfil ``where``.

    ``sums`` are expressions over the feed's columns by name, with the types that the sums are
    kept in. Nulls add nothing; a sum without any value is null.
    """

    path: str
    table: StateTable
    by: Sequence[str]
    sums: Mapping[str, tuple[str, T.DataType]] = field(default_factory=dict)
    where: str = "true"

    @property
    def journal(self) -> str:
        return f"{self.path}/{tables.VERSIONS}"

    @property
    def schema(self) -> T.StructType:
        groups = [self.table.schema[name] for name in self.by]
        kept = [T.StructField(ROWS, T.LongType())]
        for name, (_, kind) in self.sums.items():
            kept += [T.StructField(name, kind), T.StructField(_values(name), T.LongType())]
        return T.StructType([*groups, *kept])

    def read(self, spark: SparkSession, rows: str = "rows") -> DataFrame:
        """The groups that have rows, with their number and sums."""
        shown = [F.when(F.col(_values(name)) > 0, F.col(name)).alias(name) for name in self.sums]
        return self._stored(spark).select(*self.by, F.col(ROWS).alias(rows), *shown)

    def _stored(self, spark: SparkSession) -> DataFrame:
        now = journal.newest(spark, self.journal)
        if not now or not now["run"]:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.path}/data/run={now['run']}")


def _values(name: str) -> str:
    return f"_values_{name}"


def contributions(rows: DataFrame, kept: SumTable, sign: int = 1) -> DataFrame:
    """What each row adds to its group, or with ``sign`` -1 takes off it."""
    parts = [F.lit(sign).cast("bigint").alias(ROWS)]
    for name, (expression, kind) in kept.sums.items():
        value = F.expr(expression).cast(kind)
        signed = value if sign > 0 else -value
        parts.append(F.coalesce(signed, F.lit(0)).cast(kind).alias(name))
        parts.append(F.when(value.isNotNull(), sign).otherwise(0).cast("bigint").alias(_values(name)))
    return rows.where(kept.where).select(*kept.by, *parts)


def added_up(parts: Sequence[DataFrame], kept: SumTable) -> DataFrame:
    """The sums of contributions and stored sums; groups without rows are left out. Each task
    adds up before it sends, so a large group costs a row per task."""
    summed = [
        F.sum(f.name).cast(f.dataType).alias(f.name) for f in kept.schema.fields if f.name not in kept.by
    ]
    together = reduce(DataFrame.unionByName, parts).groupBy(*kept.by).agg(*summed)
    return together.where(F.col(ROWS) > 0)


def refresh(spark: SparkSession, kept: SumTable) -> bool:
    """Bring the sums up to the newest version of the table; True if the feed was enough, False
    if the table had to be read, as it has when it was made anew or its feed is gone."""
    now, newest = journal.newest(spark, kept.journal), kept.table.version(spark)
    since = now["of"] if now else 0
    if now and since == newest:
        return True
    missed = [journal.entry(spark, kept.table.journal, v) for v in range(since + 1, newest + 1)]
    fed = bool(missed) and all(e["operation"] in KEEPS_ROWS or e["feed"] or not e["won"] for e in missed)
    runs = [e["feed"] for e in missed if e["feed"]]
    fed = fed and all(files.exists(spark, kept.table.feed_folder(run)) for run in runs)
    if fed:
        before, after = kept.table.feed_rows(spark, runs)
        parts = [kept._stored(spark), contributions(before, kept, -1), contributions(after, kept)]
    else:
        parts = [contributions(kept.table.read(spark), kept)]
    run = uuid.uuid4().hex
    added_up(parts, kept).write.parquet(f"{kept.path}/data/run={run}")
    journal.add(spark, kept.journal, (now["version"] if now else 0) + 1, {"run": run, "of": newest})
    if now and now["run"]:
        files.delete(spark, f"{kept.path}/data/run={now['run']}")
    return fed
