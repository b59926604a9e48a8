from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.windows import DayWindow, one_day
from medallion.sources import forms, tables
from tests.conftest import final_plan, tuples


def day(spark, number, ddl, *rows):
    load_date = f"2024010{number}"
    return spark.createDataFrame([(*row, load_date) for row in rows], f"{ddl}, load_date string"), one_day(load_date)


def put(spark, path, number, ddl, *rows, renames=None):
    df, window = day(spark, number, ddl, *rows)
    tables.replace_days(df, path, window, renames=renames)


def read(spark, path, ddl):
    return tables.read(spark, path, T._parse_datatype_string(f"{ddl}, load_date string"))


def three_generations(spark, path):
    put(spark, path, 1, "id int, v decimal(10,2), kind string", (1, Decimal("1.25"), "a"))
    put(spark, path, 2, "id bigint, v decimal(12,4), kind string, more date", (1 << 40, Decimal("2.0625"), "b", date(2024, 1, 2)))
    put(spark, path, 3, "id bigint, v decimal(12,4), channel string", (3, None, "c"), renames={"kind": "channel"})


def test_three_generations_are_one_table(spark, folder):
    three_generations(spark, folder + "/t")
    rows = read(spark, folder + "/t", "id bigint, v decimal(14,4), channel string, more date")
    assert tuples(rows, "id", "v", "channel", "more") == sorted([
        (1, Decimal("1.2500"), "a", None),
        (1 << 40, Decimal("2.0625"), "b", date(2024, 1, 2)),
        (3, None, "c", None),
    ], key=repr)
    assert tuples(rows.where("load_date = '20240101' AND channel = 'a'"), "id") == [(1,)]
    some = tables.read_days(spark, folder + "/t", rows.schema, DayWindow(date(2024, 1, 2), date(2024, 1, 3)))
    assert tuples(some, "id") == [(1 << 40,), (3,)]


def test_a_narrower_type_is_refused(spark, folder):
    path = folder + "/t"
    three_generations(spark, path)
    before = tuples(read(spark, path, "id bigint, channel string"))
    for ddl, row in (
        ("id int", (1,)), ("v decimal(12,2)", (None,)), ("v decimal(12,5)", (None,)),
        ("channel int", (1,)), ("more string", ("x",)),
    ):
        with pytest.raises(ValueError, match="would be narrowed"):
            put(spark, path, 4, ddl, row)
        with pytest.raises(ValueError, match="would be narrowed"):
            read(spark, path, ddl)
    assert tuples(read(spark, path, "id bigint, channel string")) == before


def test_a_full_refresh_begins_a_new_history(spark, folder):
    path = folder + "/t"
    three_generations(spark, path)
    df, _ = day(spark, 5, "id string", ("x",))
    tables.refresh_days(df, path)
    assert tuples(read(spark, path, "id string")) == [("x", "20240105")]


def test_a_name_that_is_used_again_is_another_column(spark, folder):
    path = folder + "/t"
    put(spark, path, 1, "a string", ("old a",))
    put(spark, path, 2, "b string", ("was a",), renames={"a": "b"})
    put(spark, path, 3, "a int, b string", (7, "now b"))
    put(spark, path, 4, "a int, c string", (8, "was b"), renames={"b": "c"})
    rows = read(spark, path, "a int, c string")
    assert tuples(rows, "load_date", "a", "c") == [
        ("20240101", None, "old a"), ("20240102", None, "was a"),
        ("20240103", 7, "now b"), ("20240104", 8, "was b"),
    ]


def test_days_of_one_form_are_one_scan(spark, folder):
    path = folder + "/t"
    put(spark, path, 1, "id int", (1,))
    put(spark, path, 2, "id int, more string", (2, "x"))
    put(spark, path, 3, "id int, more string", (3, "y"))
    plan = final_plan(read(spark, path, "id int, more string")).split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1
    put(spark, path, 4, "id bigint, more string", (4, "z"))
    wider = read(spark, path, "id bigint, more string")
    assert final_plan(wider).split("== Initial Plan ==")[0].count("FileScan") == 3
    assert tuples(wider, "id", "more") == [(1, None), (2, "x"), (3, "y"), (4, "z")]
    filtered = final_plan(wider.where(F.col("load_date") == "20240104"))
    assert "PartitionFilters: [isnotnull(load_date" in filtered


@pytest.mark.parametrize("old, new, fits", [
    ("tinyint", "smallint", True), ("smallint", "int", True), ("int", "bigint", True), ("bigint", "int", False),
    ("float", "double", True), ("int", "double", True), ("bigint", "double", False), ("double", "float", False),
    ("decimal(10,2)", "decimal(10,2)", True), ("decimal(10,2)", "decimal(12,4)", True),
    ("decimal(10,2)", "decimal(11,4)", False), ("int", "decimal(10,0)", True), ("bigint", "decimal(18,0)", False),
    ("bigint", "decimal(21,2)", True), ("date", "timestamp_ntz", True), ("timestamp_ntz", "date", False),
    ("string", "int", False), ("int", "string", False),
])
def test_types_that_hold_all_values_of_others(old, new, fits):
    assert forms.widens(T._parse_datatype_string(old), T._parse_datatype_string(new)) is fits
