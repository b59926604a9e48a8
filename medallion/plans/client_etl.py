"""The daily job: landing files to bronze, bronze to silver.

    python -m medallion.plans.client_etl --mode d-1 --landing L --bronze B --silver S --buckets N
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion import session
from medallion.functions.phones import null_unless
from medallion.operators.dedupe import distinct_stored
from medallion.operators.upsert import StateTable, rebuild, upsert
from medallion.operators.windows import DayWindow, day_window, one_day
from medallion.schema import LONG, TEXT, TIME, struct
from medallion.session import work_folder
from medallion.sources import journal, ledger, tables
from medallion.sources.landing import (
    Landing,
    bad_lines,
    days_found,
    events,
    good_lines,
    judged,
    scan,
)

NEW_FILES = "new-files"
# Files carry no event number: of versions of equal time the later load day counts, then
# the later ingest. What one ingest brings twice is decided by a hash of the contents.
CONTENT = "content_hash"
VERSION_ORDER = ("updated_at", "load_date", "ingested_at", CONTENT)
BRONZE_OPERATION = struct(
    version=LONG,
    operation=TEXT,
    run_ts=TIME,
    rows=LONG,
    rejects=LONG,
    days=T.ArrayType(T.StringType()),
)


def bronze_schema(landing: Landing) -> T.StructType:
    types = dict(zip(landing.business_columns, landing.schema.fields, strict=True))
    fields = [T.StructField(name, field.dataType) for name, field in types.items()]
    return T.StructType(
        fields
        + [
            T.StructField("source_file", T.StringType()),
            T.StructField("ingested_at", T.TimestampNTZType()),
            T.StructField("load_date", T.StringType()),
        ]
    )


@dataclass(frozen=True)
class ClientEtl:
    """Where the job reads and writes.

    Rejected lines go to a by-day table of their own, by default beside bronze, and so does the
    ledger of the files taken in.
    ``bronze_table`` and ``silver_table`` are the catalog's names for the tables; with them
    the job registers what it wrote.
    """

    landing: Landing
    bronze_path: str
    silver_path: str
    buckets: int
    rejects_path: str | None = None
    bronze_table: str | None = None
    silver_table: str | None = None
    phone: str = "phone"

    @property
    def rejects(self) -> str:
        return self.rejects_path or f"{self.bronze_path}_rejects"

    @property
    def ledger(self) -> str:
        return f"{self.bronze_path}_files"

    @property
    def journal(self) -> str:
        return f"{self.bronze_path}/{tables.VERSIONS}"

    @property
    def silver(self) -> StateTable:
        schema = T.StructType([*bronze_schema(self.landing).fields, T.StructField(CONTENT, LONG)])
        return StateTable(self.silver_path, schema, self.buckets, "client_id", VERSION_ORDER)


@dataclass(frozen=True)
class EtlResult:
    """Audit of the bronze write and of the silver upsert, one row each."""

    bronze: DataFrame
    silver: DataFrame


def bronze_operations(spark: SparkSession, job: ClientEtl) -> DataFrame:
    """What each run wrote to bronze: rows, rejected lines and days."""
    return journal.history(spark, job.journal, BRONZE_OPERATION)


def rejects(spark: SparkSession, job: ClientEtl) -> DataFrame:
    """The lines that the newest run of each day could not take in, and why."""
    added = struct(line=TEXT, load_date=TEXT, source_file=TEXT, reason=TEXT)
    schema = T.StructType([*job.landing.schema.fields, *added.fields])
    return tables.read_days(spark, job.rejects, schema, DayWindow())


def update_bronze(
    spark: SparkSession,
    job: ClientEtl,
    window: DayWindow,
    mode: str,
    run_ts: datetime,
    load_date: str | None = None,
) -> DataFrame:
    """Put the window's events into bronze in place of what it had for those days.

    A day whose landing folder is gone stays as it is; one whose folder is there without a
    good line becomes empty. A full refresh takes the place of everything, and is refused if
    there is no folder at all. The files are parsed once.

    One entry makes all days new and holds the audit. What follows it, rejects, ledger and
    catalog, is made good by a rerun if the driver is lost in between.
    """
    found = days_found(spark, job.landing, window)
    if window.everything and not found:
        raise FileNotFoundError(f"no day folders in {job.landing.path}: nothing to refresh from")
    listed = ledger.listing(spark, job.landing, window)
    stamp = F.lit(run_ts.isoformat(" ")).cast("timestamp_ntz")
    schema = bronze_schema(job.landing)
    lines = _parsed(spark, job, window)
    good = good_lines(lines, job.landing)
    rows = events(good, job.landing, stamp, load_date, distinct_stored)
    days = None if window.everything else found
    if load_date and not window.everything:
        window, days = one_day(load_date), [load_date] if found else []
    stage = tables.stage_gathered if tables.gathered_by_day(lines) else tables.stage_days
    new = stage(rows.select(*schema.names), job.bronze_path, window, days)
    rejected = tables.stage_days(
        bad_lines(lines), job.rejects, DayWindow(), None if days is None else found
    )
    version = new.commit(operation=mode, run_ts=run_ts.isoformat(" "), rejects=rejected.rows)
    rejected.commit()
    ledger.record(listed, job.ledger, found)
    if job.bronze_table:
        everything = window.everything
        folders = tables.day_folders(spark, job.bronze_path, window)
        tables.register(
            spark, job.bronze_table, job.bronze_path, schema, tables.DAY, folders, everything
        )
    return journal.one(spark, job.journal, version, BRONZE_OPERATION)


def late_days(spark: SparkSession, job: ClientEtl, window: DayWindow = DayWindow()) -> DayWindow:
    """Days of the window whose files are not those that were last taken in."""
    listed = ledger.listing(spark, job.landing, window)
    return DayWindow(listed=tuple(ledger.changed_days(spark, listed, job.ledger, window)))


def _parsed(spark: SparkSession, job: ClientEtl, window: DayWindow) -> DataFrame:
    lines = judged(scan(spark, job.landing, window), job.landing)
    path = work_folder(spark, "lines")
    lines.write.parquet(path)
    return spark.read.schema(lines.schema).parquet(path)


def silver_source(bronze: DataFrame, phone: str = "phone") -> DataFrame:
    """What silver takes from bronze: well-formed phones only.

    The phone is cleaned before the newest version is chosen, so that versions compare
    the same way whether they meet in one batch or one of them is in silver already.
    """
    return bronze.withColumn(phone, null_unless(F.col(phone)))


def update_silver(
    spark: SparkSession, job: ClientEtl, days: DayWindow, batch_id: str, run_ts: Column
) -> DataFrame:
    """Upsert those days of bronze; all days make silver anew.

    A version brought in again counts as unchanged.
    """
    bronze = tables.read_days(spark, job.bronze_path, bronze_schema(job.landing), days)
    business = job.landing.business_columns
    source = silver_source(bronze, job.phone).withColumn(CONTENT, F.xxhash64(*business))
    if days.everything:
        audit = rebuild(spark, job.silver, source, batch_id, run_ts)
    else:
        same = [name for name in [*business, "load_date"] if name != job.silver.key]
        audit = upsert(spark, job.silver, source, batch_id, run_ts, same)
    if job.silver_table:
        job.silver.register(spark, job.silver_table)
    return audit


def run(
    spark: SparkSession,
    job: ClientEtl,
    mode: str,
    as_of: date,
    run_ts: datetime,
    start_day: str | None = None,
    load_date: str | None = None,
) -> EtlResult:
    """One run of the job for the days that ``mode`` names, seen from ``as_of``.

    ``new-files`` takes in the days, from ``start_day`` on or of all time, in which files have
    come, changed or gone since they were last taken in.

    ``load_date`` (YYYYMMDD) puts all of the run's events under the day of processing
    instead of the days of their folders.
    """
    if mode == NEW_FILES:
        if load_date:
            raise ValueError("new-files takes whole days of the landing zone: no load_date")
        within = day_window("d-x", as_of, start_day) if start_day else DayWindow()
        window = late_days(spark, job, within)
    else:
        window = day_window(mode, as_of, start_day)
    bronze = update_bronze(spark, job, window, mode, run_ts, load_date)
    stamp = F.lit(run_ts.isoformat(" ")).cast("timestamp_ntz")
    days = one_day(load_date) if load_date and not window.everything else window
    silver = update_silver(spark, job, days, f"{mode}-{as_of:%Y%m%d}", stamp)
    return EtlResult(bronze, silver)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Landing files to bronze and silver.")
    parser.add_argument("--mode", required=True, choices=("d-1", "d-x", "full-refresh", NEW_FILES))
    parser.add_argument("--start-day", help="first day of d-x or new-files, YYYYMMDD")
    parser.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    parser.add_argument("--load-date", help="day of processing for all events, YYYYMMDD")
    for name in ("landing", "bronze", "silver"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--buckets", type=int, required=True)
    parser.add_argument("--rejects")
    parser.add_argument("--bronze-table")
    parser.add_argument("--silver-table")
    given = parser.parse_args(arguments)
    job = ClientEtl(
        Landing(given.landing),
        given.bronze,
        given.silver,
        given.buckets,
        given.rejects,
        given.bronze_table,
        given.silver_table,
    )
    spark = session.build("client-etl")
    result = run(
        spark, job, given.mode, given.as_of, datetime.now(), given.start_day, given.load_date
    )
    result.bronze.show(truncate=False)
    result.silver.show(truncate=False)


if __name__ == "__main__":
    main()
