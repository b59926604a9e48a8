from __future__ import annotations

import os
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from medallion.operators.windows import DayWindow
from medallion.schema import LONG, TEXT, TIME, struct
from medallion.sources import files, journal, tables
from tests.conftest import final_plan, tuples

SCHEMA = struct(id=LONG, load_date=TEXT)
FIRST_THREE = DayWindow(date(2024, 1, 1), date(2024, 1, 3))


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def full(spark, path):
    return tuples(tables.read(spark, path, SCHEMA))


def test_replacing_days_twice_is_the_same_as_once(spark, folder):
    path = folder + "/t"
    tables.refresh_days(rows(spark, (1, "20240101"), (9, "20240109")), path)
    for _ in range(2):
        batch = rows(spark, (2, "20240102"), (3, "20240101"))
        assert tables.replace_days(batch, path, FIRST_THREE) == 2
    assert full(spark, path) == [(2, "20240102"), (3, "20240101"), (9, "20240109")]


def test_a_day_missing_from_the_batch_becomes_empty(spark, folder):
    path = folder + "/t"
    tables.refresh_days(rows(spark, (1, "20240101"), (2, "20240102"), (9, "20240109")), path)
    tables.replace_days(rows(spark, (5, "20240101")), path, FIRST_THREE)
    assert full(spark, path) == [(5, "20240101"), (9, "20240109")]


def test_an_empty_batch_empties_the_window(spark, folder):
    path = folder + "/t"
    tables.refresh_days(rows(spark, (1, "20240101"), (9, "20240109")), path)
    assert tables.replace_days(rows(spark), path, FIRST_THREE) == 0
    assert full(spark, path) == [(9, "20240109")]


def test_a_row_outside_the_window_stops_the_write(spark, folder):
    path = folder + "/t"
    tables.refresh_days(rows(spark, (1, "20240101"), (9, "20240109")), path)
    with pytest.raises(Exception, match="row outside the days to replace"):
        tables.replace_days(rows(spark, (2, "20240101"), (3, "20240109")), path, FIRST_THREE)
    assert full(spark, path) == [(1, "20240101"), (9, "20240109")]


def test_first_write_needs_no_table(spark, folder):
    tables.replace_days(rows(spark, (2, "20240102")), folder + "/t", FIRST_THREE)
    assert full(spark, folder + "/t") == [(2, "20240102")]


def test_full_refresh_replaces_rows_and_columns(spark, folder):
    path = folder + "/t"
    tables.refresh_days(rows(spark, (1, "20240101"), (9, "20240109")), path)
    other = spark.createDataFrame([("x", "20240105")], "kind string, load_date string")
    tables.refresh_days(other, path)
    assert tuples(tables.read(spark, path, other.schema)) == [("x", "20240105")]
    (only,) = tables.day_folders(spark, path).values()
    assert spark.read.parquet(only).columns == ["kind"]


def test_a_failed_refresh_leaves_the_table_as_it_was(spark, folder):
    path = folder + "/t"
    tables.refresh_days(rows(spark, (1, "20240101"), (9, "20240109")), path)
    broken = rows(spark, (2, "20240101")).withColumn("id", F.raise_error(F.lit("bad source")))
    with pytest.raises(Exception, match="bad source"):
        tables.refresh_days(broken.withColumn("id", F.col("id").cast("bigint")), path)
    assert full(spark, path) == [(1, "20240101"), (9, "20240109")]


def test_days_are_text_and_prune_folders(spark, folder):
    path = folder + "/t"
    tables.refresh_days(rows(spark, *[(n, f"2024010{n}") for n in range(1, 8)]), path)
    window = tables.read_days(spark, path, SCHEMA, FIRST_THREE)
    assert dict(window.dtypes)["load_date"] == "string"
    assert len(window.inputFiles()) == 3
    assert tuples(window) == [(n, f"2024010{n}") for n in (1, 2, 3)]
    plan = final_plan(tables.read(spark, path, SCHEMA).where(F.col("load_date") == "20240102"))
    assert "PartitionFilters: [isnotnull(load_date" in plan


def test_window_without_any_day_is_empty(spark, folder):
    path = folder + "/t"
    tables.refresh_days(rows(spark, (9, "20240109")), path)
    assert tables.read_days(spark, path, SCHEMA, FIRST_THREE).count() == 0
    assert tables.read_days(spark, folder + "/none", SCHEMA, DayWindow()).count() == 0


def test_a_hot_day_is_written_by_several_tasks(spark, folder):
    path = folder + "/t"
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        many = spark.range(0, 300_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, "20240101").otherwise(
                F.concat(F.lit("202402"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"))
            ).alias("load_date")
        )
        tables.refresh_days(many, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    hot = tables.day_folders(spark, path)["20240101"]
    assert len(os.listdir(hot)) > 4  # files and their checksums
    assert tables.read(spark, path, SCHEMA).count() == 300_000


def test_a_single_day_is_written_without_a_shuffle(spark, folder):
    path = folder + "/t"
    day = DayWindow(date(2024, 1, 1), date(2024, 1, 1))
    many = spark.range(0, 1000, 1, 3).select("id", F.lit("20240101").alias("load_date"))
    assert tables.replace_days(many, path, day) == 1000
    files_written = [f for f in os.listdir(tables.day_folders(spark, path)["20240101"]) if f.endswith("parquet")]
    assert len(files_written) == 3


def test_older_files_lack_new_columns(spark, folder):
    path = folder + "/t"
    tables.refresh_days(rows(spark, (1, "20240101")), path)
    names = "id bigint, kind string, load_date string"
    wider = spark.createDataFrame([(2, "x", "20240102")], names)
    tables.replace_days(wider, path, DayWindow(date(2024, 1, 2), date(2024, 1, 2)))
    assert tuples(tables.read(spark, path, wider.schema)) == [
        (1, None, "20240101"),
        (2, "x", "20240102"),
    ]


@pytest.mark.parametrize("lost_in", ["DataFrame", "commit"])
def test_a_driver_lost_leaves_all_days_old(spark, folder, monkeypatch, lost_in):
    path = folder + "/t"
    tables.refresh_days(rows(spark, (1, "20240101"), (2, "20240102"), (9, "20240109")), path)
    before = full(spark, path)

    def lost(*_, **__):
        raise RuntimeError("driver lost")

    new = rows(spark, (11, "20240101"), (12, "20240102"))
    with monkeypatch.context() as patch:
        if lost_in == "commit":
            patch.setattr(tables.journal, "add", lost)
        else:
            patch.setattr(tables, "_observed", lambda df: (df, type("Lost", (), {"get": property(lost)})()))
        with pytest.raises(RuntimeError):
            tables.replace_days(new, path, FIRST_THREE)
    assert full(spark, path) == before
    tables.replace_days(new, path, FIRST_THREE)
    assert full(spark, path) == [(11, "20240101"), (12, "20240102"), (9, "20240109")]


def test_of_two_writers_one_fails_without_effect(spark, folder):
    path = folder + "/t"
    tables.refresh_days(rows(spark, (1, "20240101"), (9, "20240109")), path)
    slow = tables.stage_days(rows(spark, (2, "20240101")), path, FIRST_THREE)
    tables.replace_days(rows(spark, (3, "20240102")), path, FIRST_THREE)
    with pytest.raises(journal.ConcurrentWrite):
        slow.commit()
    assert full(spark, path) == [(3, "20240102"), (9, "20240109")]


def test_staged_days_are_seen_after_the_commit_only(spark, folder):
    path = folder + "/t"
    staged = tables.stage_days(rows(spark, (1, "20240101"), (2, "20240102")), path, FIRST_THREE)
    assert tables.read_days(spark, path, SCHEMA, DayWindow()).count() == 0
    assert (staged.rows, staged.days, staged.commit()) == (2, ["20240101", "20240102"], 1)
    assert full(spark, path) == [(1, "20240101"), (2, "20240102")]


def test_readers_keep_their_version_until_vacuum(spark, folder):
    path = folder + "/t"
    tables.refresh_days(rows(spark, (1, "20240101"), (2, "20240102")), path)
    reader = tables.read(spark, path, SCHEMA)
    tables.replace_days(rows(spark, (5, "20240102")), path, FIRST_THREE, ["20240102"])
    assert tuples(reader) == [(1, "20240101"), (2, "20240102")]
    tables.vacuum_days(spark, path)
    assert full(spark, path) == [(1, "20240101"), (5, "20240102")]
    held = [os.path.join(top, d) for top, folders, _ in os.walk(path) for d in folders if "load_date" in d]
    assert sorted(held) == sorted(tables.day_folders(spark, path).values())


def test_listed_days(spark, folder):
    path = folder + "/t"
    tables.refresh_days(rows(spark, *[(n, f"2024010{n}") for n in range(1, 8)]), path)
    some = DayWindow(listed=("20240105", "20240102"))
    assert tuples(tables.read_days(spark, path, SCHEMA, some)) == [(2, "20240102"), (5, "20240105")]
    tables.replace_days(rows(spark, (50, "20240105")), path, some)
    assert [r[0] for r in full(spark, path)] == [1, 3, 4, 50, 6, 7]
    none = DayWindow(listed=())
    assert not none.everything and tables.read_days(spark, path, SCHEMA, none).count() == 0
    assert tables.replace_days(rows(spark), path, none) == 0
    assert len(full(spark, path)) == 6


@pytest.fixture
def catalog_name(spark):
    name = f"days_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_catalog_knows_the_registered_days(spark, folder, catalog_name):
    path, name = folder + "/t", catalog_name
    tables.refresh_days(rows(spark, (1, "20240101"), (2, "20240102"), (3, "20240103")), path)
    folders = tables.day_folders(spark, path)
    two = {day: folders[day] for day in ("20240101", "20240103")}
    for _ in range(2):
        tables.register(spark, name, path, SCHEMA, "load_date", two)
    assert tuples(spark.table(name)) == [(1, "20240101"), (3, "20240103")]
    tables.register(spark, name, path, SCHEMA, "load_date", {"20240102": folders["20240102"]})
    assert spark.table(name).count() == 3
    tables.register(spark, name, path, SCHEMA, "load_date", two, everything=True)
    assert spark.table(name).count() == 2


def test_catalog_readers_see_every_partition_at_any_time(spark, folder, catalog_name, monkeypatch):
    path, name = folder + "/t", catalog_name
    days = [f"2024010{n}" for n in range(1, 6)]
    tables.refresh_days(rows(spark, *[(n, day) for n, day in enumerate(days)]), path)
    tables.register(spark, name, path, SCHEMA, "load_date", tables.day_folders(spark, path), True)
    names = "id bigint, kind string, load_date string"
    wider = spark.createDataFrame([(10 + n, "x", day) for n, day in enumerate(days)], names)
    tables.refresh_days(wider, path)
    sql, seen = type(spark).sql, []

    def watched(session, statement, *arguments, **named):
        result = sql(session, statement, *arguments, **named)
        if statement.startswith(("ALTER", "DROP", "CREATE")):
            spark.catalog.refreshTable(name)
            seen.append(sorted(r[0] for r in spark.table(name).select("load_date").collect()))
        return result

    monkeypatch.setattr(type(spark), "sql", watched)
    tables.register(spark, name, path, wider.schema, "load_date", tables.day_folders(spark, path), True)
    monkeypatch.undo()
    assert len(seen) >= 6 and all(found == days for found in seen)
    assert tuples(spark.table(name), "id", "kind") == [(10 + n, "x") for n in range(5)]


def test_unfinished_files_do_not_count(spark, folder):
    os.makedirs(folder + "/t/_temporary/0")
    assert not files.exists(spark, folder + "/t")
    assert not files.exists(spark, folder + "/nowhere")


def test_timestamps_keep_microseconds(spark, folder):
    when = datetime(2024, 1, 1, 0, 0, 0, 123456)
    df = spark.createDataFrame([(when, "20240101")], struct(ts=TIME, load_date=TEXT))
    tables.refresh_days(df, folder + "/t")
    assert tables.read(spark, folder + "/t", df.schema).first().ts == when
