"""Dated CSV landing folders: one folder per day, files at any depth below it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.dedupe import distinct_events
from medallion.operators.windows import DayWindow
from medallion.schema import CLIENT_HEADER, DAY_FOLDER, DAY_FOLDER_GLOB, client_schema
from medallion.sources import files

BAD_LINE, REASON = "_bad_line", "reason"


@dataclass(frozen=True)
class Landing:
    """How the files of one landing zone are read.

    ``required`` columns must not be null. ``upper`` columns are upper-cased and
    ``renames`` applied after the read. With ``keep_bad_lines`` a line that does not fit
    the schema stays, with nulls for what could not be read; otherwise it is a reject.

    ``header`` are the column names in the files, in order; by default those of the
    original client files for their schema, and the schema's own names for any other. A
    file with another header stops the run.
    """

    path: str
    schema: T.StructType = field(default_factory=client_schema)
    required: Sequence[str] = ("client_id",)
    upper: Sequence[str] = ("name",)
    renames: Mapping[str, str] = field(default_factory=dict)
    options: Mapping[str, str] = field(default_factory=dict)
    keep_bad_lines: bool = False
    header: Sequence[str] = ()

    @property
    def file_names(self) -> list[str]:
        default = CLIENT_HEADER if self.schema == client_schema() else self.schema.names
        return list(self.header or default)

    @property
    def business_columns(self) -> list[str]:
        return [self.renames.get(name, name) for name in self.schema.names]


def _line_schema(landing: Landing, lineage: bool = False) -> T.StructType:
    added = [BAD_LINE, "load_date", "source_file"] if lineage else [BAD_LINE]
    return T.StructType(
        landing.schema.fields + [T.StructField(name, T.StringType()) for name in added]
    )


def _configured(reader, landing: Landing):
    options = {
        "header": "true",
        "enforceSchema": "false",
        "recursiveFileLookup": "true",
        "pathGlobFilter": "*.csv",
        "columnNameOfCorruptRecord": BAD_LINE,
        **landing.options,
    }
    in_file = [
        T.StructField(name, field.dataType)
        for name, field in zip(landing.file_names, landing.schema.fields, strict=True)
    ]
    bad = T.StructField(BAD_LINE, T.StringType())
    return reader.schema(T.StructType([*in_file, bad])).options(**options)


def _with_lineage(lines: DataFrame, landing: Landing) -> DataFrame:
    file = F.col("_metadata.file_path")
    names = dict(zip(landing.file_names, landing.schema.names, strict=True))
    lines = lines.select(*[F.col(a).alias(b) for a, b in names.items()], BAD_LINE, "_metadata")
    return lines.withColumns(
        {"load_date": F.regexp_extract(file, DAY_FOLDER, 1), "source_file": file}
    ).drop("_metadata")


def _any_null(names: Sequence[str]) -> Column:
    return reduce(or_, (F.col(name).isNull() for name in names), F.lit(False))


def _does_not_fit(landing: Landing) -> Column:
    # The CSV parser looks only at the columns a query uses, so a line counts as bad or
    # not depending on the select list. The null count, true for every row, makes each
    # query use all columns, and the answer always the same.
    nulls = reduce(add, (F.col(name).isNull().cast("int") for name in landing.schema.names))
    return F.col(BAD_LINE).isNotNull() & (nulls >= 0)


def scan(spark: SparkSession, landing: Landing, window: DayWindow) -> DataFrame:
    """Every line of the window's folders, with its day and file.

    The glob limits the file listing to the window, and days without a folder are simply
    empty.
    """
    reader = _configured(spark.read, landing)
    folders = f"{landing.path}/{DAY_FOLDER_GLOB}{window.glob()}"
    if not files.any_matching(spark, folders):
        if not files.exists(spark, landing.path):
            raise FileNotFoundError(f"no landing folders at {landing.path}")
        return spark.createDataFrame([], _line_schema(landing, lineage=True))
    lines = reader.csv(folders)
    return _with_lineage(lines, landing).where(window.holds(F.col("load_date")))


def stream(
    spark: SparkSession, landing: Landing, files_per_batch: int | None = None
) -> DataFrame:
    """Every line of every day folder, as a stream of new files."""
    reader = _configured(spark.readStream, landing)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.csv(f"{landing.path}/{DAY_FOLDER_GLOB}{DayWindow().glob()}")
    return _with_lineage(lines, landing)


def judged(lines: DataFrame, landing: Landing) -> DataFrame:
    """The lines with the reason why one is rejected; null for a good one."""
    reason = F.when(_any_null(landing.required), "null_key")
    if not landing.keep_bad_lines:
        reason = F.when(_does_not_fit(landing), "bad_line").otherwise(reason)
    return lines.withColumn(REASON, reason)


def good_lines(lines: DataFrame, landing: Landing) -> DataFrame:
    """Of judged lines the good ones, cleaned."""
    rows = lines.where(F.col(REASON).isNull()).drop(BAD_LINE, REASON)
    return rows.withColumns({name: F.upper(name) for name in landing.upper}).withColumnsRenamed(
        dict(landing.renames)
    )


def bad_lines(lines: DataFrame) -> DataFrame:
    """Of judged lines the others: what was read of them, the raw line if it was bad, and why."""
    return lines.where(F.col(REASON).isNotNull()).withColumnRenamed(BAD_LINE, "line")


def accepted(lines: DataFrame, landing: Landing) -> DataFrame:
    """The lines that fit the schema and have their required columns, cleaned."""
    return good_lines(judged(lines, landing), landing)


def rejects(lines: DataFrame, landing: Landing) -> DataFrame:
    """The other lines, with the reason."""
    return bad_lines(judged(lines, landing))


def days_found(spark: SparkSession, landing: Landing, window: DayWindow) -> list[str]:
    """The days of the window that have a folder."""
    names = files.matching(spark, f"{landing.path}/{DAY_FOLDER_GLOB}{window.glob()}")
    days = sorted({name[-8:] for name in names})
    return days if window.everything else sorted(set(days).intersection(window.days()))


def ingest(
    spark: SparkSession,
    landing: Landing,
    window: DayWindow,
    ingested_at: Column,
    load_date: str | None = None,
) -> DataFrame:
    """Accepted lines of the window without exact copies, with lineage columns.

    Two lines are copies when all business columns and the load date agree, in whatever
    files they lie. ``load_date`` (YYYYMMDD) is the day of the batch; by default each
    row has the day of its folder.
    """
    rows = accepted(scan(spark, landing, window), landing)
    return events(rows, landing, ingested_at, load_date)


def events(
    rows: DataFrame,
    landing: Landing,
    ingested_at: Column,
    load_date: str | None = None,
    distinct: Callable[[DataFrame, Sequence[str]], DataFrame] = distinct_events,
) -> DataFrame:
    """Accepted lines without exact copies, as ``ingest`` returns them; ``distinct`` is
    ``distinct_stored`` for rows that are cheap to read again."""
    if load_date is not None:
        rows = rows.withColumn("load_date", F.lit(load_date))
    return distinct(rows, [*landing.business_columns, "load_date"]).withColumn(
        "ingested_at", ingested_at
    )
