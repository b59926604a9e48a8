"""Which landing files have been taken in, so that late and changed ones are found.

The ledger is a by-day table of files: path, length and time of modification, as they were when
their day was last taken in. A day of the landing zone is to be taken in if its files are not
those of the ledger. Spark lists the files; their contents are not read for it.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.windows import DayWindow
from medallion.schema import DAY_FOLDER, DAY_FOLDER_GLOB, LONG, TEXT, struct
from medallion.session import work_folder
from medallion.sources import files, tables
from medallion.sources.landing import Landing

FILES = struct(path=TEXT, length=LONG, modified=T.TimestampType(), load_date=TEXT)
FILE = ["path", "length", "modified"]


def listing(spark: SparkSession, landing: Landing, window: DayWindow) -> DataFrame:
    """The files of the window's folders as they are now, in a written table: a file that comes
    or changes later is not among them, whatever is read meanwhile."""
    folders = f"{landing.path}/{DAY_FOLDER_GLOB}{window.glob()}"
    if not files.any_matching(spark, folders):
        return spark.createDataFrame([], FILES)
    names = landing.options.get("pathGlobFilter", "*.csv")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = reader.option("pathGlobFilter", names).load(folders).select(
        "path",
        "length",
        F.col("modificationTime").alias("modified"),
        F.regexp_extract("path", DAY_FOLDER, 1).alias(tables.DAY),
    )
    path = work_folder(spark, "files")
    found.where(window.holds(F.col(tables.DAY))).write.parquet(path)
    return spark.read.schema(FILES).parquet(path)


def changed_days(spark: SparkSession, listed: DataFrame, ledger: str, window: DayWindow) -> list[str]:
    """Days with a file that the ledger lacks or has otherwise, or without one that it has.

    A day that has no files left is not among them, just as one without a folder.
    """
    taken = tables.read_days(spark, ledger, FILES, window)
    new = listed.join(taken, [*FILE, tables.DAY], "left_anti").select(tables.DAY)
    gone = taken.join(listed, [*FILE, tables.DAY], "left_anti").select(tables.DAY)
    gone = gone.join(listed.select(tables.DAY).distinct(), tables.DAY, "left_semi")
    # Names of days.
    return sorted(row[0] for row in new.union(gone).distinct().collect())


def record(listed: DataFrame, ledger: str, days: Collection[str]) -> None:
    """Note that those days were taken in with the files listed."""
    if days:
        window = DayWindow(listed=tuple(days))
        tables.replace_days(listed.where(window.holds(F.col(tables.DAY))), ledger, window)
