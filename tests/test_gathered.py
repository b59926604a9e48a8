"""Rows that lie by day already are written without a shuffle, and copies found by hash."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from medallion.operators import dedupe
from medallion.operators.dedupe import distinct_events, distinct_stored
from medallion.operators.windows import DayWindow
from medallion.sources import tables
from tests.conftest import final_plan

IDENTITY = ["a", "b", "x", "load_date"]


def _stored(spark, folder, rows):
    schema = "a string, b string, x double, load_date string, source_file string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/rows")
    return spark.read.parquet(f"{folder}/rows")


ROWS = [
    ("1", None, 0.0, "20240101", "b.csv"),
    ("1", None, -0.0, "20240101", "a.csv"),
    (None, "1", 0.0, "20240101", "c.csv"),
    ("2", "2", float("nan"), "20240102", "c.csv"),
    ("2", "2", float("nan"), "20240102", "d.csv"),
    ("3", "3", 1.0, "20240102", "d.csv"),
    ("3", "3", 1.0, "20240103", "d.csv"),
]


@pytest.mark.parametrize("few", [1_000_000, 1])
def test_stored_copies_are_merged_as_others_are(spark, folder, monkeypatch, few):
    monkeypatch.setattr(dedupe, "FEW", few)
    rows = _stored(spark, folder, ROWS)
    found = distinct_stored(rows, IDENTITY)
    expected = distinct_events(rows, IDENTITY)
    shown = [F.to_json(F.struct(*expected.columns), {"ignoreNullFields": "false"})]
    assert found.columns == expected.columns
    assert sorted(found.select(*shown).collect()) == sorted(expected.select(*shown).collect())
    assert found.count() == 5


def test_without_copies_no_row_is_shuffled(spark, folder):
    found = distinct_stored(_stored(spark, folder, ROWS[2:4] + ROWS[5:]), IDENTITY)
    assert found.count() == 4
    assert "Exchange" not in final_plan(found)


def test_gathered_rows_are_written_where_they_lie(spark, folder, monkeypatch):
    days = spark.range(400).withColumn("load_date", F.concat(F.lit("2024010"), (F.col("id") % 4).cast("string")))
    days.repartition(2, "load_date").write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    assert not tables.gathered_by_day(rows)
    monkeypatch.setattr(tables, "PIECE_ROWS", 100)
    assert tables.gathered_by_day(rows)
    days.repartition(8).write.parquet(f"{folder}/scattered")
    assert not tables.gathered_by_day(spark.read.parquet(f"{folder}/scattered"))
    plan = tables._by_day(rows, DayWindow(), True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Rebalance" not in plan
    staged = tables.stage_gathered(rows, f"{folder}/table", DayWindow())
    staged.commit()
    assert staged.rows == 400 and len(staged.days) == 4
    written = tables.read(spark, f"{folder}/table", rows.schema)
    assert sorted(written.collect()) == sorted(rows.collect())
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
