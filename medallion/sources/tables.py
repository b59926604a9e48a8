"""Parquet tables of the lake: by-day bronze, catalog entries.

A by-day table has its days in folders of the runs that wrote them, and a journal beside them
whose newest entry names the folder of each day. A run replaces any number of days with one
entry: a driver lost before leaves all of them old, and of two writers that start from the same
version the later one fails without effect. Readers keep the version they found until
``vacuum_days`` deletes its folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.windows import DayWindow
from medallion.sources import files, forms, journal

DAY = "load_date"
VERSIONS = "versions"
NOTHING = {"version": 0, "folders": {}, "form_of": {}, "history": None}
# Partitions named in one ALTER TABLE statement.
PARTITIONS_PER_STATEMENT = 500
# Rows of one day that make a file large enough not to be put together with others.
PIECE_ROWS = 100_000
# Days whose files a task keeps open at a time, instead of sorting its rows by day.
DAYS_OPEN = "32"


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table under a fixed schema.

    The schema gives partition columns their right type (paths alone would turn days
    into integers) and columns missing from older files come back null, without a look
    at every footer. Of a by-day table it is the newest version.
    """
    now = journal.newest(spark, f"{path}/{VERSIONS}")
    if now is None:
        return spark.read.schema(schema).parquet(path)
    return _read_folders(spark, path, schema, now, DayWindow())


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if files.exists(spark, path):
        return read(spark, path, schema)
    return spark.createDataFrame([], schema)


def read_days(
    spark: SparkSession, path: str, schema: T.StructType, window: DayWindow
) -> DataFrame:
    """The window's days of a by-day table; only their folders are listed."""
    now = journal.newest(spark, f"{path}/{VERSIONS}")
    if now is None:
        return spark.createDataFrame([], schema)
    return _read_folders(spark, path, schema, now, window).where(window.holds(F.col(DAY)))


def _read_folders(
    spark: SparkSession, path: str, schema: T.StructType, now: dict, window: DayWindow
) -> DataFrame:
    """Days of a version, in one scan as far as the files have the columns as asked for; those of
    each form that has other types or names are a scan of their own."""
    scans: dict[int | None, list[str]] = {}
    made = {}
    for folder in day_folders(spark, path, window, now).values():
        number = now["form_of"][folder.split("/run=")[1].split("/")[0]]
        if number not in made:
            made[number] = forms.columns(now["history"], number, schema)
        scans.setdefault(None if made[number] is None else number, []).append(folder)
    parts = []
    for number, folders in scans.items():
        held = schema if number is None else T.StructType.fromJson(now["history"]["forms"][number])
        rows = spark.read.schema(held).option("basePath", f"{path}/data").parquet(*folders)
        chosen = [made[number][name].alias(name) for name in schema.names] if number is not None else schema.names
        parts.append(rows.select(*chosen))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def day_folders(
    spark: SparkSession, path: str, window: DayWindow | None = None, now: dict | None = None
) -> dict[str, str]:
    """Folder of each day that the table has, or has in the window; one name per day."""
    now = now or journal.newest(spark, f"{path}/{VERSIONS}")
    found = {
        day: f"{path}/data/run={run}/{DAY}={day}"
        for run, days in (now["folders"] if now else {}).items()
        for day in days
    }
    if window is not None and not window.everything:
        found = {day: found[day] for day in window.days() if day in found}
    return dict(sorted(found.items()))


def _by_day(df: DataFrame, window: DayWindow, gathered: bool) -> DataFrame:
    # Rebalancing gives small days one file and splits a day that holds much of the
    # data over several tasks; a plain repartition by day would put it into one. Tasks
    # that all write the same day, or a few days each, need no further shuffle.
    return df if window.single or gathered else df.hint("rebalance", F.col(DAY))


def gathered_by_day(df: DataFrame) -> bool:
    """Whether the files of the rows read hold, of each day in them, many rows on average. Only
    the day column is read."""
    pieces = df.groupBy(F.col("_metadata.file_path"), DAY).agg(F.count("*").alias("rows"))
    total = pieces.agg(F.sum("rows").alias("rows"), F.count("*").alias("pieces")).first()
    return bool(total["pieces"]) and total["rows"] >= PIECE_ROWS * total["pieces"]


@contextmanager
def days_open(spark: SparkSession) -> Iterator[None]:
    """Tasks that write rows of a few days hold the files of all open. The sort by day that Spark
    does otherwise would spill, as such tasks are as large as a scan makes them."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, DAYS_OPEN)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    # Measured in the writing tasks themselves, each of which counts once however often
    # it is tried.
    written = Observation()
    rows = df.observe(
        written, F.count(F.lit(1)).alias("rows"), F.collect_set(DAY).alias("days")
    )
    return rows, written


@dataclass(frozen=True)
class StagedDays:
    """Finished files of some days that no entry names yet."""

    spark: SparkSession
    path: str
    version: int
    layout: dict
    rows: int
    days: list[str]

    def commit(self, **facts) -> int:
        """Make the days the table's, all at once, and return the new version.

        Raises ``ConcurrentWrite``, without effect, if the table has changed meanwhile. The
        entry holds ``facts`` too.
        """
        entry = {**self.layout, "rows": self.rows, "days": self.days, **facts}
        journal.add(self.spark, f"{self.path}/{VERSIONS}", self.version, entry)
        return self.version


def stage_days(
    df: DataFrame,
    path: str,
    window: DayWindow,
    days: Collection[str] | None = None,
    renames: Mapping[str, str] | None = None,
    gathered: bool = False,
) -> StagedDays:
    """Write the files with which days of the table become exactly the rows given.

    The days are those of the window, or of them the ones in ``days``: a row of another day
    stops the write, and a day that the table has but ``df`` has not is emptied. The files lie
    in a folder of this run alone; nobody reads them before ``commit``.

    ``df`` may have more columns than the table, and wider types; a narrower one is refused, as
    long as the table keeps other days. ``renames`` are columns that have another name from now
    on, from old to new. Rows that are ``gathered`` come in large pieces of one day each, and are
    written where they lie.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    now = journal.newest(spark, f"{path}/{VERSIONS}") or NOTHING
    kept = None if window.everything and days is None else now["history"]
    history = forms.extended(kept, df.schema, renames or {})
    replaced = set(day_folders(spark, path, window, now))
    held = window.holds(F.col(DAY))
    if days is not None:
        replaced &= set(days)
        held &= F.col(DAY).isin(*days)
    if days is not None or not window.everything:
        outside = F.concat(F.lit("row outside the days to replace: "), F.col(DAY))
        df = df.withColumn(DAY, F.when(held, F.col(DAY)).otherwise(F.raise_error(outside)))
    rows, written = _observed(_by_day(df, window, gathered))
    with days_open(spark) if gathered else nullcontext():
        rows.write.partitionBy(DAY).parquet(f"{path}/data/run={run}")
    metrics = written.get
    filled = sorted(metrics.get("days", ()))
    folders = {owner: sorted(set(held) - replaced - set(filled)) for owner, held in now["folders"].items()}
    folders = {owner: held for owner, held in folders.items() if held} | ({run: filled} if filled else {})
    form_of = {**now["form_of"], run: len(history["forms"]) - 1}
    layout = {
        "folders": folders,
        "form_of": {owner: form_of[owner] for owner in folders},
        "history": history,
    }
    return StagedDays(spark, path, now["version"] + 1, layout, metrics.get("rows", 0), filled)


def stage_gathered(df: DataFrame, path: str, window: DayWindow, days: Collection[str] | None = None) -> StagedDays:
    """``stage_days`` of rows that are gathered by day."""
    return stage_days(df, path, window, days, gathered=True)


def replace_days(
    df: DataFrame,
    path: str,
    window: DayWindow,
    days: Collection[str] | None = None,
    renames: Mapping[str, str] | None = None,
) -> int:
    """Make days of the table exactly the rows given, all at once; a rerun changes nothing.
    Returns the rows written. See ``stage_days``."""
    staged = stage_days(df, path, window, days, renames)
    staged.commit()
    return staged.rows


def refresh_days(df: DataFrame, path: str) -> int:
    """Replace the whole table, columns included. Returns the rows written."""
    return replace_days(df, path, DayWindow())


def vacuum_days(spark: SparkSession, path: str) -> None:
    """Delete day folders that the newest version does not name. Not to be run while the table
    is being written, or an older version still being read."""
    now = journal.newest(spark, f"{path}/{VERSIONS}") or NOTHING
    for name in files.matching(spark, f"{path}/data/run=*"):
        named = now["folders"].get(name.partition("=")[2], ())
        if not named:
            files.delete(spark, f"{path}/data/{name}")
            continue
        for day in partitions(spark, f"{path}/data/{name}", DAY):
            if day not in named:
                files.delete(spark, f"{path}/data/{name}/{DAY}={day}")


def register(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType,
    column: str,
    folders: Mapping[str, str] | Sequence[str],
    everything: bool = False,
) -> None:
    """Make a partitioned table known to the catalog, and the given values of its partition
    column as partitions, in the folders given for them or below ``path``.

    Only the partitions of the run are named, so the cost does not grow with the table; with
    ``everything`` they are all there are, and partitions that the catalog has beyond them are
    dropped. A partition that has moved is pointed to its new folder in one statement, and new
    columns are added in place, so that a reader sees every partition all the time. Only a table
    whose columns changed otherwise is registered anew, which needs all partitions.
    """
    known_types = _types(spark.table(table).schema) if spark.catalog.tableExists(table) else {}
    added = [f for f in schema.fields if f.name not in known_types]
    kept = {name: kind for name, kind in _types(schema).items() if name in known_types}
    if known_types and kept != known_types:
        if not everything:
            raise ValueError(f"{table} has other columns: register all of its partitions")
        spark.sql(f"DROP TABLE {table}")  # external: the files stay
    elif known_types and added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(added)})")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({_columns(schema.fields)}) USING parquet "
        f"PARTITIONED BY ({column}) LOCATION '{path}'"
    )
    known = {row[0].partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    located = dict(folders) if isinstance(folders, Mapping) else {}
    for value in sorted(known.intersection(located)):
        where = f"PARTITION ({column}='{value}') SET LOCATION '{located[value]}'"
        spark.sql(f"ALTER TABLE {table} {where}")
    new = {value: located.get(value) for value in folders if value not in known}
    _alter(spark, table, column, "ADD IF NOT EXISTS", new, " ")
    gone = known.difference(folders) if everything else ()
    _alter(spark, table, column, "DROP IF EXISTS", dict.fromkeys(gone), ", ")
    spark.catalog.refreshTable(table)


def _columns(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _types(schema: T.StructType) -> dict[str, T.DataType]:
    return {field.name: field.dataType for field in schema.fields}


def _alter(spark, table, column, what, folders: Mapping[str, str | None], between: str) -> None:
    ordered = sorted(folders)
    for start in range(0, len(ordered), PARTITIONS_PER_STATEMENT):
        named = between.join(
            f"PARTITION ({column}='{value}')" + (f" LOCATION '{folders[value]}'" if folders[value] else "")
            for value in ordered[start : start + PARTITIONS_PER_STATEMENT]
        )
        spark.sql(f"ALTER TABLE {table} {what} {named}")


def partitions(spark: SparkSession, path: str, column: str, glob: str = "*") -> list[str]:
    """Values of the partition column that have a folder."""
    folders = files.matching(spark, f"{path}/{column}={glob}")
    return [name.partition("=")[2] for name in folders]
