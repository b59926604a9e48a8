"""Client tables derived from the test tables, and written once per session.

One order is one registration event of its customer. Faults (nulls, odd phones, outlying
incomes) are put in by rules on the event number, the same in Spark and in the SQL of
``medallion.plans.oracles``. Tables go to the shared folder, rebalanced, so that the
queries on them start from a table scan as they would in a lake.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.upsert import StateTable, upsert
from medallion.plans.client_etl import silver_source
from medallion.quality.engine import write_reference
from medallion.schema import DATE, DOUBLE, LONG, MONEY, TEXT, TIME, client_schema, struct
from medallion.session import work_folder
from medallion.sources import tables
from medallion.sources.landing import Landing

TRAIL = struct(
    client_id=LONG,
    event_id=LONG,
    name=TEXT,
    country=TEXT,
    city=TEXT,
    street=TEXT,
    house_no=TEXT,
    phone=TEXT,
    birth_date=DATE,
    updated_at=TIME,
    person_type=TEXT,
    income=MONEY,
    op=TEXT,
    load_date=TEXT,
)
# Fixed: microseconds are lost in the default CSV time format.
CSV_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
EVENTS = struct(
    event_id=LONG,
    ts=TIME,
    user_id=LONG,
    event_type=TEXT,
    value=DOUBLE,
    props=TEXT,
)

# Of the state tables here, at every size, so that audits do not depend on it.
STATE_BUCKETS = 8

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a derived table, written on first use in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = work_folder(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_ts():
    return F.lit("2001-08-02 00:00:00").cast("timestamp_ntz")


def trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    k, u, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    phone = F.concat(
        F.lit("("),
        F.lpad((11 + u % 89).cast("string"), 2, "0"),
        F.when(k % 8 == 2, ") ").otherwise(")"),
        F.when(k % 8 == 3, "9999").otherwise("99999"),
        F.lit("-"),
        F.lpad((k % 10000).cast("string"), 4, "0"),
    )
    events = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return events.select(
        u.alias("client_id"),
        k.alias("event_id"),
        F.when(k % 53 != 0, F.col("c_name")).alias("name"),
        F.col("n_name").alias("country"),
        *_address(u),
        F.when(k % 61 != 0, (u % 200).cast("string")).alias("house_no"),
        F.when(k % 8 == 0, None).when(k % 8 == 1, "n/a").otherwise(phone).alias("phone"),
        F.date_add(F.lit("1880-01-01").cast("date"), ((u * 37) % 52000).cast("int")).alias(
            "birth_date"
        ),
        F.col("o_orderdate").alias("updated_at"),
        F.when(F.col("o_orderstatus") == "O", "PF")
        .when(F.col("o_orderstatus") == "F", "PJ")
        .otherwise("XX")
        .alias("person_type"),
        F.when(k % 97 == 0, -price)
        .when(k % 89 == 0, price * 10)
        .otherwise(price)
        .cast("decimal(10,2)")
        .alias("income"),
        F.when(k % 23 == 0, "D").otherwise("U").alias("op"),
        (F.year("o_orderdate") * 10000 + 101).cast("string").alias("load_date"),
    )


def _address(customer_key):
    return (
        F.concat(F.lit("City "), (customer_key % 40).cast("string")).alias("city"),
        F.concat(F.lit("Street "), (customer_key % 97).cast("string")).alias("street"),
    )


ADDRESS = struct(country=TEXT, city=TEXT, street=TEXT, house_no=TEXT)


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known addresses: those of every customer outside the HOUSEHOLD segment."""

    def write(path: str) -> None:
        write_reference(_customer_addresses(spark, sf_dir), path, ADDRESS.names)

    return tables.read(spark, _once(spark, sf_dir, "addresses", write), ADDRESS)


def _customer_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment") != "HOUSEHOLD")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("country"),
            *_address(u),
            (u % 200).cast("string").alias("house_no"),
        )
    )


def bronze_path(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        tables.refresh_days(trail(spark, sf_dir), path)

    return _once(spark, sf_dir, "bronze", write)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, bronze_path(spark, sf_dir), TRAIL)


def state_table(path: str, schema: T.StructType = TRAIL) -> StateTable:
    return StateTable(path, schema, STATE_BUCKETS)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        source = silver_source(bronze(spark, sf_dir))
        upsert(spark, state_table(path), source, "first", run_ts())

    return state_table(_once(spark, sf_dir, "silver", write)).read(spark)


def write_landing(df: DataFrame, path: str, by_day: bool = False) -> None:
    """Add CSV files in day folders, by the column ``particao``; ``by_day`` says that the rows
    come from a table by day, whose files need not be dealt anew."""
    # One job for all days; the hot ones are split over several files.
    days = df if by_day else df.hint("rebalance", F.col("particao"))
    days = days.write.partitionBy("particao").mode("append").options(header="true", **CSV_TIMES)
    with tables.days_open(df.sparkSession) if by_day else nullcontext():
        days.csv(path)


def events_landing(spark: SparkSession, sf_dir: str) -> Landing:
    """Daily CSV folders of the events table."""

    def write(path: str) -> None:
        events = table(spark, sf_dir, "events").select(*EVENTS.names)
        write_landing(events.withColumn("particao", F.date_format("ts", "yyyyMMdd")), path)

    return Landing(
        path=_once(spark, sf_dir, "events_landing", write),
        schema=EVENTS,
        required=("event_id",),
        upper=("event_type",),
        renames={"props": "properties"},
        options=CSV_TIMES,
    )


def client_landing(spark: SparkSession, sf_dir: str) -> Landing:
    """Daily CSV folders of the client trail, its events a microsecond apart at least, so that
    no two versions of a client have the same time."""

    def write(path: str) -> None:
        rows = distinct_times(bronze(spark, sf_dir)).withColumn("particao", F.col("load_date"))
        write_landing(rows.select(*client_schema().names, "particao"), path, by_day=True)

    path = _once(spark, sf_dir, "client_landing", write)
    return Landing(path, options=CSV_TIMES, header=client_schema().names)


def corrected_landing(spark: SparkSession, sf_dir: str) -> Landing:
    """The same from 1996 on, delivered again: every fifth event is withdrawn, and every
    seventh has another street at the same time."""

    def write(path: str) -> None:
        rows = distinct_times(bronze(spark, sf_dir)).where(
            (F.col("load_date") >= "19960101") & (F.col("event_id") % 5 != 0)
        )
        street = F.when(F.col("event_id") % 7 == 0, F.concat("street", F.lit(" B")))
        rows = rows.withColumn("street", F.coalesce(street, F.col("street")))
        rows = rows.withColumn("particao", F.col("load_date"))
        write_landing(rows.select(*client_schema().names, "particao"), path, by_day=True)

    path = _once(spark, sf_dir, "corrected_landing", write)
    return Landing(path, options=CSV_TIMES, header=client_schema().names)


def distinct_times(trail: DataFrame) -> DataFrame:
    micros = F.make_dt_interval(secs=F.col("event_id") / F.lit(Decimal(1_000_000)))
    return trail.withColumn("updated_at", F.col("updated_at") + micros)


def faulty_landing(spark: SparkSession, sf_dir: str) -> Landing:
    """The events as CSV lines of all columns, quotes and commas in the last, some of them with a
    fault."""

    def write(path: str) -> None:
        k = F.col("event_id")
        event, user, kind = k.cast("string"), F.col("user_id").cast("string"), F.col("event_type")
        value = F.col("value").cast("string")
        props = F.concat(F.lit('"'), F.replace("props", F.lit('"'), F.lit('""')), F.lit(', x"'))
        time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        line = (
            F.when(k % 11 == 0, F.concat_ws(",", event, time, F.lit("zz"), kind, value, props))
            .when(k % 13 == 0, F.concat_ws(",", event, time))
            .when(k % 17 == 0, F.concat_ws(",", event, time, user, kind, value, props, F.lit("extra")))
            .when(k % 19 == 0, F.concat_ws(",", F.lit(""), time, user, kind, value, props))
            .when(k % 23 == 0, F.concat_ws(",", event, time, user, kind, F.lit("1.5.2"), props))
            .otherwise(F.concat_ws(",", event, time, user, kind, value, props))
        )
        day = F.date_format("ts", "yyyyMMdd").alias("particao")
        lines = table(spark, sf_dir, "events").select(line.alias("value"), day)
        lines.hint("rebalance", F.col("particao")).write.partitionBy("particao").text(path)

    return Landing(
        path=_once(spark, sf_dir, "faulty_landing", write),
        schema=EVENTS,
        required=("event_id",),
        upper=(),
        options={**CSV_TIMES, "header": "false", "pathGlobFilter": "*.txt", "escape": '"'},
    )
