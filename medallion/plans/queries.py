"""The registered queries: name -> (spark, folder of the test tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion import fixtures
from medallion.functions.phones import null_unless
from medallion.operators import analytics, cdc, sums
from medallion.operators.dedupe import distinct_events, latest_per_key
from medallion.operators.upsert import StateTable, last_operation, late_events, rebuild, upsert
from medallion.operators.windows import DayWindow, day_window
from medallion.plans import client_etl, report
from medallion.quality import engine, rules
from medallion.quality.incremental import check_changes, violations
from medallion.schema import BUSINESS_COLUMNS, DAY_FOLDER, PERSON_TYPES, TEXT, struct
from medallion.session import work_folder
from medallion.sources import files, tables
from medallion.sources.landing import Landing, accepted, ingest, rejects, scan
from medallion.streaming.changes import apply_change_stream, apply_keyed_stream

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2001, 8, 2)
EVENTS_AS_OF = date(2024, 1, 31)
EVENTS_START = "20240120"
BATCH_SPLIT = "1999-01-01"
ORDER = ("updated_at", "event_id")
STATE_COLUMNS = (
    "client_id event_id name country city street house_no phone birth_date updated_at "
    "person_type income"
).split()


def comparable(df: DataFrame) -> DataFrame:
    """Dates, times and decimals as text, whose form does not depend on the engine."""
    shown = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, (T.DateType, T.DecimalType)):
            column = column.cast("string")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def _first_batch(trail: DataFrame) -> DataFrame:
    return trail.where(F.col("updated_at") < F.lit(BATCH_SPLIT).cast("timestamp_ntz"))


def _second_batch(trail: DataFrame) -> DataFrame:
    """The newer events, and once more the late half of the older ones."""
    return trail.where(F.col("updated_at") >= F.lit("1997-01-01").cast("timestamp_ntz"))


# Ingest ---------------------------------------------------------------------------------


def ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = fixtures.events_landing(spark, sf_dir)
    rows = ingest(spark, landing, DayWindow(), F.lit("2024-01-31 06:00:00").cast("timestamp_ntz"))
    folder_day = F.regexp_extract("source_file", DAY_FOLDER, 1)
    return comparable(rows.withColumn("source_day", folder_day).drop("source_file"))


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = fixtures.faulty_landing(spark, sf_dir)
    found = rejects(scan(spark, landing, DayWindow()), landing)
    event = F.col("event_id").cast("string").alias("event_id")
    return found.select(event, "event_type", "value", "props", "line", "reason", "load_date")


def ingest_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = fixtures.faulty_landing(spark, sf_dir)
    rows = accepted(scan(spark, landing, DayWindow()), landing)
    return comparable(rows.drop("source_file"))


def _window(mode: str, start_day: str | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        landing = fixtures.events_landing(spark, sf_dir)
        window = day_window(mode, EVENTS_AS_OF, start_day)
        rows = accepted(scan(spark, landing, window), landing)
        return comparable(rows.drop("source_file"))

    return query


# Bronze ---------------------------------------------------------------------------------


def _daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.table(spark, sf_dir, "events").select(*fixtures.EVENTS.names)
    return events.withColumn("load_date", F.date_format("ts", "yyyyMMdd"))


def _daily_schema(*extra: T.StructField) -> T.StructType:
    day = T.StructField("load_date", T.StringType())
    return T.StructType([*fixtures.EVENTS.fields, *extra, day])


def bronze_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _daily_events(spark, sf_dir)
    copies = events.withColumn("source_file", F.lit("b.csv")).union(
        events.withColumn("source_file", F.lit("a.csv"))
    )
    return comparable(distinct_events(copies, events.columns))


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day brought in after the days before it, and once more."""
    path = work_folder(spark, "bronze_append")
    events = _daily_events(spark, sf_dir)
    last = day_window("d-1", EVENTS_AS_OF)
    earlier = events.where(F.col("load_date") < last.days()[0])
    tables.refresh_days(earlier, path)
    for _ in range(2):
        tables.replace_days(events.where(last.holds(F.col("load_date"))), path, last)
    return comparable(tables.read(spark, path, _daily_schema()))


def bronze_missing_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over all of January when the landing has lost the days before the 11th, and holds
    the 20th without any line: only the latter becomes empty."""
    folder = work_folder(spark, "bronze_missing_day")
    days = _daily_events(spark, sf_dir).withColumn("particao", F.col("load_date"))
    landing = Landing(f"{folder}/landing", fixtures.EVENTS, ("event_id",), (), options=fixtures.CSV_TIMES)
    job = client_etl.ClientEtl(landing, f"{folder}/bronze", f"{folder}/silver", fixtures.STATE_BUCKETS)
    fixtures.write_landing(days.select(*fixtures.EVENTS.names, "particao"), landing.path)
    january = DayWindow(date(2024, 1, 1), date(2024, 1, 31))
    client_etl.update_bronze(spark, job, january, "d-x", datetime(2024, 1, 31))
    later = days.where((F.col("load_date") >= "20240111") & (F.col("load_date") != "20240120"))
    later = later.withColumn("event_type", F.upper("event_type"))
    left = replace(landing, path=f"{folder}/left")
    fixtures.write_landing(later.select(*fixtures.EVENTS.names, "particao"), left.path)
    files.create_text(spark, f"{left.path}/particao=20240120/empty.csv", ",".join(fixtures.EVENTS.names))
    client_etl.update_bronze(spark, replace(job, landing=left), january, "d-x", datetime(2024, 2, 1))
    return comparable(tables.read(spark, job.bronze_path, _daily_schema()))


def bronze_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over all of January, and one over new files when a seventh of the events of its first
    ten days have come in late and the file of the 20th was delivered anew without clicks. The
    time of ingest tells which days were taken in again."""
    folder = work_folder(spark, "bronze_late_files")
    events = _daily_events(spark, sf_dir).withColumn("particao", F.col("load_date"))
    landing = Landing(f"{folder}/landing", fixtures.EVENTS, ("event_id",), (), options=fixtures.CSV_TIMES)
    job = client_etl.ClientEtl(landing, f"{folder}/bronze", f"{folder}/silver", fixtures.STATE_BUCKETS)
    late = (F.col("event_id") % 7 == 0) & (F.col("load_date") <= "20240110")
    columns = [*fixtures.EVENTS.names, "particao"]
    fixtures.write_landing(events.where(~late).select(*columns), landing.path)
    client_etl.update_bronze(spark, job, DayWindow(), "full-refresh", datetime(2024, 1, 31))
    fixtures.write_landing(events.where(late).select(*columns), landing.path)
    files.delete(spark, f"{landing.path}/particao=20240120")
    anew = events.where((F.col("load_date") == "20240120") & (F.col("event_type") != "click"))
    fixtures.write_landing(anew.select(*columns), landing.path)
    for stamp in (datetime(2024, 2, 1), datetime(2024, 2, 2)):
        window = client_etl.late_days(spark, job)
        client_etl.update_bronze(spark, job, window, client_etl.NEW_FILES, stamp)
    rows = tables.read(spark, job.bronze_path, client_etl.bronze_schema(landing))
    return comparable(rows.drop("source_file"))


def bronze_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the runs of a job wrote: all days, some of them again, and a day without folder."""
    folder = work_folder(spark, "bronze_audit")
    landing = fixtures.faulty_landing(spark, sf_dir)
    job = client_etl.ClientEtl(landing, f"{folder}/bronze", f"{folder}/silver", fixtures.STATE_BUCKETS)
    runs = (
        ("full-refresh", DayWindow(), datetime(2024, 1, 31, 6)),
        ("d-x", DayWindow(date(2024, 1, 10), date(2024, 1, 12)), datetime(2024, 1, 31, 7)),
        ("d-1", DayWindow(date(2023, 12, 31), date(2023, 12, 31)), datetime(2024, 1, 31, 8)),
    )
    for mode, window, stamp in runs:
        client_etl.update_bronze(spark, job, window, mode, stamp)
    audit = client_etl.bronze_operations(spark, job)
    return comparable(audit.withColumn("days", F.concat_ws(",", "days")))


def bronze_replace_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days replaced by their rows of one kind; the last of them becomes empty."""
    path = work_folder(spark, "bronze_replace_days")
    events = _daily_events(spark, sf_dir)
    window = DayWindow(date(2024, 1, 10), date(2024, 1, 12))
    tables.refresh_days(events, path)
    new = events.where(
        window.holds(F.col("load_date"))
        & (F.col("event_type") == "click")
        & (F.col("load_date") != "20240112")
    )
    tables.replace_days(new, path, window)
    return comparable(tables.read(spark, path, _daily_schema()))


def bronze_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load with other columns takes the place of the first."""
    path = work_folder(spark, "bronze_full_refresh")
    events = _daily_events(spark, sf_dir)
    tables.refresh_days(events, path)
    other = events.drop("props", "value").withColumn("kind", F.upper("event_type"))
    tables.refresh_days(other, path)
    schema = T.StructType(
        [*fixtures.EVENTS.fields[:4], *struct(kind=TEXT, load_date=TEXT).fields]
    )
    return comparable(tables.read(spark, path, schema))


def bronze_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of January has files with one more column; other days show it as null."""
    path = work_folder(spark, "bronze_evolve")
    events = _daily_events(spark, sf_dir)
    new = DayWindow(date(2024, 1, 16), date(2024, 1, 31))
    day = F.col("load_date")
    narrow = events.where((day < "20240116") | (day > "20240131"))
    tables.refresh_days(narrow, path)
    wider = events.where(new.holds(day)).withColumn("channel", F.upper("event_type"))
    tables.replace_days(wider, path, new)
    return comparable(
        tables.read(spark, path, _daily_schema(T.StructField("channel", T.StringType())))
    )


def bronze_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three generations of files as one table: narrow numbers under an old name, wider ones, and
    a new name with wider decimals still."""
    path = work_folder(spark, "bronze_forms")
    events, day = _daily_events(spark, sf_dir), F.col("load_date")
    amount = (F.col("event_id") % 1000).cast("decimal(10,2)")

    def generation(user: str, kind: str, number: str) -> DataFrame:
        return events.select(
            "event_id", F.col("user_id").cast(user).alias("user_id"), F.col("event_type").alias(kind),
            amount.cast(number).alias("amount"), "load_date",
        )

    first = generation("int", "kind", "decimal(10,2)").where(day < "20240111")
    second = generation("bigint", "kind", "decimal(12,2)").where(day.between("20240111", "20240120"))
    third = generation("bigint", "channel", "decimal(20,6)").where(day > "20240120")
    tables.refresh_days(first, path)
    tables.replace_days(second, path, DayWindow(date(2024, 1, 11), date(2024, 1, 20)))
    later = DayWindow(date(2024, 1, 21), date(2024, 12, 31))
    tables.replace_days(third, path, later, renames={"kind": "channel"})
    return comparable(tables.read(spark, path, third.schema))


def bronze_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of some load days; the other days' folders are not listed."""
    window = DayWindow(date(1997, 1, 1), date(1999, 12, 31))
    rows = tables.read_days(spark, fixtures.bronze_path(spark, sf_dir), fixtures.TRAIL, window)
    return rows.select("client_id", "event_id", "load_date")


def catalog_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog after a refresh that drops the year 1995 and brings one more column."""
    path = work_folder(spark, "catalog_partitions")
    name = f"client_bronze_{uuid.uuid4().hex}"
    trail = fixtures.bronze(spark, sf_dir)
    wider = trail.where("load_date <> '19950101'").withColumn("kind", F.lower("person_type"))
    for table in (trail, wider.select(*trail.columns[:-1], "kind", "load_date")):
        tables.refresh_days(table, path)
        days = tables.day_folders(spark, path)
        tables.register(spark, name, path, table.schema, "load_date", days, everything=True)
    return spark.table(name).groupBy("load_date", "kind").agg(F.count(F.lit(1)).alias("events"))


# Silver ---------------------------------------------------------------------------------


def silver_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    trail = fixtures.bronze(spark, sf_dir).select(*STATE_COLUMNS)
    return comparable(latest_per_key(trail, "client_id", ORDER))


def silver_phone_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    trail = fixtures.bronze(spark, sf_dir).select("client_id", "event_id", "phone")
    return trail.withColumn("phone", null_unless(F.col("phone")))


def _state(folder: str) -> StateTable:
    return fixtures.state_table(folder, _columns_of(STATE_COLUMNS))


def _columns_of(names) -> T.StructType:
    return T.StructType([fixtures.TRAIL[name] for name in names])


def _two_batches(spark, sf_dir, folder, compare=()) -> DataFrame:
    trail, state, stamp = fixtures.bronze(spark, sf_dir), _state(folder), fixtures.run_ts()
    upsert(spark, state, _second_batch(trail), "new", stamp, compare)
    return upsert(spark, state, _first_batch(trail), "late", stamp, compare)


def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newer events first, then older ones, some of them for the second time."""
    folder = work_folder(spark, "silver_upsert")
    _two_batches(spark, sf_dir, folder)
    return comparable(_state(folder).read(spark))


def silver_upsert_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts when only a change of kind of person or phone counts as an update."""
    trail, state = fixtures.bronze(spark, sf_dir), _state(work_folder(spark, "silver_upsert_changed"))
    stamp, compare = fixtures.run_ts(), ("person_type", "phone")
    upsert(spark, state, _first_batch(trail), "old", stamp, compare)
    return upsert(spark, state, _second_batch(trail), "new", stamp, compare).select(
        "batch_id", "inserted", "updated", "unchanged", "stale"
    )


def silver_changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table itself after such batches, one by one: the same as without."""
    trail, state = fixtures.bronze(spark, sf_dir), _state(work_folder(spark, "silver_changed_rows"))
    for number in range(3):
        part = trail.where(F.col("event_id") % 3 == number)
        upsert(spark, state, part, f"{number}", fixtures.run_ts(), ("person_type", "phone"))
    return comparable(state.read(spark))


def silver_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table made anew from the older events alone, in another number of buckets."""
    folder = work_folder(spark, "silver_rebuild")
    _two_batches(spark, sf_dir, folder)
    state = replace(_state(folder), buckets=3)
    rebuild(spark, state, _first_batch(fixtures.bronze(spark, sf_dir)), "anew", fixtures.run_ts())
    return comparable(state.read(spark))


def batch_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "batch_audit")
    _two_batches(spark, sf_dir, folder)
    return comparable(last_operation(spark, _state(folder)))


def _client_job(spark: SparkSession, sf_dir: str, folder: str) -> client_etl.ClientEtl:
    landing = fixtures.client_landing(spark, sf_dir)
    return client_etl.ClientEtl(
        landing, f"{folder}/bronze", f"{folder}/silver", fixtures.STATE_BUCKETS
    )


def _full_load_and_corrections(spark, sf_dir, folder) -> client_etl.ClientEtl:
    job = _client_job(spark, sf_dir, folder)
    client_etl.run(spark, job, "full-refresh", AS_OF, datetime(2001, 8, 1, 6))
    later = replace(job, landing=fixtures.corrected_landing(spark, sf_dir))
    client_etl.run(spark, later, "d-x", AS_OF, datetime(2001, 8, 2, 6), "19960101")
    return later


def client_etl_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job end to end: CSV to bronze to silver, a full load and a run from a start day
    over a landing zone with corrections of the same time."""
    job = _full_load_and_corrections(spark, sf_dir, work_folder(spark, "client_etl"))
    return comparable(job.silver.read(spark).drop("source_file", "ingested_at", client_etl.CONTENT))


def client_etl_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh after that: events that were withdrawn are gone from silver."""
    job = _full_load_and_corrections(spark, sf_dir, work_folder(spark, "client_etl_refresh"))
    client_etl.run(spark, job, "full-refresh", AS_OF, datetime(2001, 8, 3, 6))
    return comparable(job.silver.read(spark).drop("source_file", "ingested_at", client_etl.CONTENT))


# Quality --------------------------------------------------------------------------------


def _rule(make: Callable[[DataFrame], rules.RowRule], on=fixtures.silver) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = on(spark, sf_dir)
        return engine.check_rows(rows, [make(rows)])

    return query


def dq_reference_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = rules.ReferenceRule(fixtures.addresses(spark, sf_dir))
    return engine.check_reference(fixtures.silver(spark, sf_dir), rule)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.quality_report(
        fixtures.silver(spark, sf_dir),
        fixtures.bronze(spark, sf_dir),
        fixtures.addresses(spark, sf_dir),
        AS_OF,
    ).drop("checked_at")


def _versioned_violations(spark: SparkSession, sf_dir: str, silver: DataFrame) -> DataFrame:
    chosen = report.client_rules(silver, fixtures.addresses(spark, sf_dir), AS_OF)
    return engine.run(silver, chosen, fixtures.run_ts(), carry=("updated_at",))


def dq_persisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The violations of two runs on an earlier and the present state; the second run is made
    twice, first on the wrong state."""
    path = work_folder(spark, "dq_persisted")
    now = _versioned_violations(spark, sf_dir, fixtures.silver(spark, sf_dir))
    before = _versioned_violations(spark, sf_dir, _earlier_silver(spark, sf_dir))
    for found, run_date in ((before, "20010801"), (before, "20010802"), (now, "20010802")):
        engine.record(found, path, run_date)
    return comparable(engine.recorded(spark, path, now.schema))


def _earlier_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = client_etl.silver_source(fixtures.bronze(spark, sf_dir))
    return latest_per_key(_first_batch(cleaned), "client_id", ORDER)


def dq_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run records that is made twice, after one on an earlier state with fewer rules."""
    folder = work_folder(spark, "dq_incremental")
    path, state = f"{folder}/violations", _state(f"{folder}/silver")
    category, nulls = rules.category("person_type", PERSON_TYPES), rules.required(BUSINESS_COLUMNS)
    cleaned = client_etl.silver_source(fixtures.bronze(spark, sf_dir))
    upsert(spark, state, _first_batch(cleaned), "first", fixtures.run_ts())
    check_changes(spark, state, [category], path, "19990101")
    upsert(spark, state, cleaned, "second", fixtures.run_ts())
    for _ in range(2):
        check_changes(spark, state, [category, nulls], path, "20010802")
    recorded = violations(spark, path, state).where("run_date = '20010802'")
    return comparable(recorded.drop("checked_at"))


def dq_mean_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean rule with a threshold from sums that were kept by differences over two batches."""
    folder = work_folder(spark, "dq_mean_kept")
    state = replace(_state(f"{folder}/silver"), feed=("income",))
    parts = report.mean_parts_of(state, f"{folder}/parts")
    cleaned = client_etl.silver_source(fixtures.bronze(spark, sf_dir))
    for batch in (_second_batch(cleaned), cleaned):
        upsert(spark, state, batch, "batch", fixtures.run_ts())
        sums.refresh(spark, parts)
    kind = state.schema["income"].dataType
    rule = rules.mean_outlier_of_sums(parts.read(spark), "income", kind)
    return engine.check_rows(state.read(spark), [rule])


def dq_mean_outlier_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean rule on incomes of 38 digits."""
    silver = fixtures.silver(spark, sf_dir)
    wide = silver.withColumn("income", F.col("income").cast("decimal(38,10)"))
    found = engine.check_rows(wide, [rules.mean_outlier(wide)])
    return found.select("client_id", F.col("offender").cast("decimal(10,2)").cast("string").alias("offender"))


# Analytics, change capture, gold --------------------------------------------------------


def top_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.most_updated_clients(fixtures.bronze(spark, sf_dir))


def top_updated_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    trail = fixtures.bronze(spark, sf_dir)
    return analytics.most_updated_clients(trail.union(trail), distinct_on=trail.columns)


def _average_age(on) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        age = analytics.average_age(on(spark, sf_dir), as_of=AS_OF)
        return age.select(F.round("avg_age_years", 6).alias("avg_age_years"))

    return query


def cdc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = fixtures.bronze(spark, sf_dir).select(*STATE_COLUMNS, "op")
    return comparable(cdc.apply_changes(changes))


def _purged(spark: SparkSession, sf_dir: str, folder: str) -> StateTable:
    """Two thirds of the older changes, a purge two years into them, and then all changes."""
    deleted = T.StructField("deleted", T.BooleanType())
    state = fixtures.state_table(folder, T.StructType([*_columns_of(STATE_COLUMNS).fields, deleted]))
    changes = cdc.with_tombstones(fixtures.bronze(spark, sf_dir).select(*STATE_COLUMNS, "op"))
    upsert(spark, state, _first_batch(changes).where("event_id % 3 <> 0"), "first", fixtures.run_ts())
    cdc.purge_tombstones(spark, state, date(1999, 1, 1), 365, "purge", fixtures.run_ts())
    upsert(spark, state, changes, "all", fixtures.run_ts())
    return state


def cdc_purged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Living clients when tombstones of more than a year have been forgotten in between."""
    state = _purged(spark, sf_dir, work_folder(spark, "cdc_purged"))
    return comparable(cdc.living(state.read(spark)))


def cdc_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that came too late for that."""
    state = _purged(spark, sf_dir, work_folder(spark, "cdc_late_events"))
    return comparable(late_events(spark, state)).select("client_id", "event_id", "updated_at", "reason")


def cdc_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``cdc_apply``, from CSV files that come in two deliveries: the newer
    changes first, then the older ones, some of them for the second time."""
    return _streamed(spark, sf_dir, work_folder(spark, "cdc_stream"), apply_change_stream)


def cdc_keyed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by way of keyed state."""
    return _streamed(spark, sf_dir, work_folder(spark, "cdc_keyed_stream"), apply_keyed_stream)


def _streamed(spark: SparkSession, sf_dir: str, folder: str, apply) -> DataFrame:
    columns = _columns_of([*STATE_COLUMNS, "op"])
    landing = Landing(f"{folder}/landing", columns, upper=(), options=fixtures.CSV_TIMES)
    deleted = T.StructField("deleted", T.BooleanType())
    kept = T.StructType([*_columns_of(STATE_COLUMNS).fields, deleted])
    state = fixtures.state_table(f"{folder}/table", kept)
    changes = fixtures.bronze(spark, sf_dir).withColumn("particao", F.col("load_date"))
    for delivery in (_second_batch(changes), _first_batch(changes)):
        fixtures.write_landing(delivery.select(*columns.names, "particao"), landing.path)
        apply(spark, landing, state, f"{folder}/checkpoint", fixtures.run_ts()).awaitTermination()
    return comparable(cdc.living(state.read(spark)))


def cdc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that the change stream could not take in."""
    folder = work_folder(spark, "cdc_rejects")
    landing = fixtures.faulty_landing(spark, sf_dir)
    kept = [f for f in fixtures.EVENTS.fields if f.name != "event_type"]
    columns = T.StructType([*kept, T.StructField("deleted", T.BooleanType())])
    state = StateTable(f"{folder}/table", columns, fixtures.STATE_BUCKETS, "event_id", ("ts",))
    apply_change_stream(
        spark, landing, state, f"{folder}/checkpoint", fixtures.run_ts(), op="event_type"
    ).awaitTermination()
    found = spark.read.parquet(f"{folder}/checkpoint/rejects")
    event = F.col("event_id").cast("string").alias("event_id")
    return found.select(event, "event_type", "value", "props", "line", "reason", "load_date")


def gold_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(report.clients_by_country(fixtures.silver(spark, sf_dir)))


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of living clients, kept by differences over batches of inserts, updates, deletes
    and late events."""
    folder = work_folder(spark, "gold_incremental")
    deleted = T.StructField("deleted", T.BooleanType())
    schema = T.StructType([*_columns_of(STATE_COLUMNS).fields, deleted])
    feed = ("country", "person_type", "income", "deleted")
    state = replace(fixtures.state_table(f"{folder}/table", schema), feed=feed)
    gold = report.clients_by_country_of(state, f"{folder}/gold", "NOT deleted")
    changes = cdc.with_tombstones(fixtures.bronze(spark, sf_dir).select(*STATE_COLUMNS, "op"))
    for batch in (_second_batch(changes), changes.where("event_id % 5 = 0"), _first_batch(changes)):
        upsert(spark, state, batch, "batch", fixtures.run_ts())
        sums.refresh(spark, gold)
    return comparable(gold.read(spark, "clients"))


def gold_dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.violations_by_rule(dq_report(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "ingest_csv": ingest_csv,
    "ingest_rejects": ingest_rejects,
    "ingest_accepted": ingest_accepted,
    "window_d1": _window("d-1"),
    "window_dx": _window("d-x", EVENTS_START),
    "window_full": _window("full-refresh"),
    "bronze_distinct": bronze_distinct,
    "bronze_append": bronze_append,
    "bronze_missing_day": bronze_missing_day,
    "bronze_late_files": bronze_late_files,
    "bronze_audit": bronze_audit,
    "bronze_replace_days": bronze_replace_days,
    "bronze_full_refresh": bronze_full_refresh,
    "bronze_evolve": bronze_evolve,
    "bronze_forms": bronze_forms,
    "bronze_window": bronze_window,
    "catalog_partitions": catalog_partitions,
    "silver_latest": silver_latest,
    "silver_phone_clean": silver_phone_clean,
    "silver_upsert": silver_upsert,
    "silver_upsert_changed": silver_upsert_changed,
    "silver_changed_rows": silver_changed_rows,
    "silver_rebuild": silver_rebuild,
    "batch_audit": batch_audit,
    "client_etl": client_etl_runs,
    "client_etl_refresh": client_etl_refresh,
    "dq_category": _rule(lambda df: rules.category("person_type", PERSON_TYPES)),
    "dq_negative": _rule(lambda df: rules.negative()),
    "dq_future_date": _rule(lambda df: rules.future_date(as_of=AS_OF)),
    "dq_age_range": _rule(lambda df: rules.age_range(as_of=AS_OF)),
    "dq_nulls": _rule(lambda df: rules.required(("name", "house_no", "phone"))),
    "dq_pattern": _rule(lambda df: rules.pattern(), on=fixtures.bronze),
    "dq_phone_extra": _rule(lambda df: rules.phone_extra(min_digits=4), on=fixtures.bronze),
    "dq_mean_outlier": _rule(rules.mean_outlier),
    "dq_mean_outlier_wide": dq_mean_outlier_wide,
    "dq_mean_kept": dq_mean_kept,
    "dq_reference_missing": dq_reference_missing,
    "dq_report": dq_report,
    "dq_incremental": dq_incremental,
    "dq_persisted": dq_persisted,
    "top_updated": top_updated,
    "top_updated_distinct": top_updated_distinct,
    "avg_age_per_event": _average_age(fixtures.bronze),
    "avg_age_per_client": _average_age(fixtures.silver),
    "cdc_apply": cdc_apply,
    "cdc_purged": cdc_purged,
    "cdc_late_events": cdc_late_events,
    "cdc_stream": cdc_stream,
    "cdc_keyed_stream": cdc_keyed_stream,
    "cdc_rejects": cdc_rejects,
    "gold_clients": gold_clients,
    "gold_incremental": gold_incremental,
    "gold_dq_summary": gold_dq_summary,
}
