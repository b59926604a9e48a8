from __future__ import annotations

import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from medallion.operators.windows import DayWindow, day_window
from medallion.schema import DATE, LONG, MONEY, TEXT, TIME, client_schema, struct
from medallion.sources.landing import Landing, accepted, ingest, rejects, scan
from tests.conftest import final_plan, tuples

SMALL = struct(id=LONG, v=MONEY, d=DATE, ts=TIME, x=TEXT)
EVERY = DayWindow()
STAMP = "2024-01-05 00:00:00"


def put(base, day, name, *lines, header="id,v,d,ts,x"):
    path = os.path.join(base, day, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as file:
        file.write("\n".join((header, *lines)) + "\n")


def small(base, **settings):
    return Landing(base, SMALL, required=("id",), upper=("x",), **settings)


def good(n, x="a"):
    return f"{n},1.50,2020-01-01,2024-01-01 10:00:00,{x}"


def take_in(spark, landing, window=EVERY, **settings):
    return ingest(spark, landing, window, F.lit(STAMP).cast("timestamp_ntz"), **settings)


def test_day_and_file_come_from_the_path(spark, folder):
    put(folder, "particao_20240101", "a.csv", good(1))
    put(folder, "particao=20240102", "b.csv", good(2))
    rows = take_in(spark, small(folder))
    assert tuples(rows, "id", "x", "load_date") == [(1, "A", "20240101"), (2, "A", "20240102")]
    assert all(r.source_file.endswith(".csv") for r in rows.collect())
    assert dict(rows.dtypes)["load_date"] == "string"


def test_files_below_a_day_folder_count_in_every_mode(spark, folder):
    put(folder, "particao_20240101", "deep/er/a.csv", good(1))
    put(folder, "particao_20240101", "b.csv", good(2))
    put(folder, "particao_20240101", "notes.txt", good(3))
    for window in (EVERY, DayWindow(date(2024, 1, 1), date(2024, 1, 1))):
        assert tuples(take_in(spark, small(folder), window), "id") == [(1,), (2,)]


def test_days_without_a_folder_are_empty(spark, folder):
    put(folder, "particao_20240101", "a.csv", good(1))
    put(folder, "particao_20240104", "a.csv", good(2))
    window = day_window("d-x", date(2024, 1, 3), "20240101")
    assert tuples(take_in(spark, small(folder), window), "id") == [(1,)]
    nothing = take_in(spark, small(folder), day_window("d-1", date(2024, 1, 3)))
    assert nothing.count() == 0
    assert nothing.columns == take_in(spark, small(folder)).columns
    assert rejects(scan(spark, small(folder), window), small(folder)).count() == 0


def test_long_windows_and_other_folders(spark, folder):
    put(folder, "particao_20230115", "a.csv", good(1))
    put(folder, "particao_20231231", "a.csv", good(2))
    put(folder, "particao_20240101", "a.csv", good(3))
    put(folder, "particao_latest", "a.csv", good(4))
    put(folder, "particao_20230116_old", "a.csv", good(5))
    window = DayWindow(date(2023, 1, 15), date(2023, 12, 30))
    assert tuples(take_in(spark, small(folder), window), "id") == [(1,)]
    assert tuples(take_in(spark, small(folder)), "id") == [(1,), (2,), (3,)]


def test_a_landing_zone_that_is_not_there_is_an_error(spark, folder):
    with pytest.raises(FileNotFoundError):
        scan(spark, small(folder + "/nowhere"), EVERY)


def test_only_the_files_of_the_window_are_read(spark, folder):
    for day in range(1, 10):
        put(folder, f"particao_2024010{day}", "a.csv", good(day))
    window = DayWindow(date(2024, 1, 2), date(2024, 1, 4))
    lines = scan(spark, small(folder), window)
    assert len(lines.inputFiles()) == 3


DIRTY = (
    "1,1234.567,2020-02-30,2024-01-01 10:00:00,",
    "2,123456789012.5,2020-02-29,bad,abc",
    "zz,1.005,2020-02-28,2024-01-01T10:00:00,q",
    "3,2.5",
    ",7,2020-01-01,2024-01-01 00:00:00,w",
    "4,-0.005,2020-01-01,2024-01-01 00:00:00,w,extra",
    "5,1.005,2020-01-01,2024-01-01 00:00:00,ok",
)


def test_lines_that_do_not_fit_are_rejected_with_reason(spark, folder):
    put(folder, "particao_20240101", "a.csv", *DIRTY)
    landing = small(folder)
    lines = scan(spark, landing, EVERY)
    kept = accepted(lines, landing)
    assert [(r.id, r.v, r.x) for r in kept.collect()] == [(5, Decimal("1.01"), "OK")]
    found = rejects(lines, landing)
    assert sorted(r.reason for r in found.collect()) == ["bad_line"] * 5 + ["null_key"]
    assert {r.line for r in found.collect()} == {*DIRTY[:4], DIRTY[5], None}


def test_selecting_fewer_columns_rejects_the_same_lines(spark, folder):
    put(folder, "particao_20240101", "a.csv", *DIRTY)
    landing = small(folder)
    lines = scan(spark, landing, EVERY)
    assert [r.id for r in accepted(lines, landing).select("id").collect()] == [5]
    assert accepted(lines, landing).select("x").count() == 1
    assert rejects(lines, landing).select("reason").count() == 6
    assert rejects(lines, landing).groupBy("load_date").count().first()["count"] == 6


def test_bad_lines_can_be_kept_with_nulls(spark, folder):
    put(folder, "particao_20240101", "a.csv", *DIRTY)
    landing = small(folder, keep_bad_lines=True)
    lines = scan(spark, landing, EVERY)
    assert sorted(r.id for r in accepted(lines, landing).collect()) == [1, 2, 3, 4, 5]
    assert [r.reason for r in rejects(lines, landing).collect()] == ["null_key"] * 2


def test_copies_in_two_files_are_one_event(spark, folder):
    put(folder, "particao_20240101", "b.csv", good(1), good(1), good(2))
    put(folder, "particao_20240101", "a.csv", good(1))
    put(folder, "particao_20240102", "c.csv", good(1))
    rows = take_in(spark, small(folder))
    shown = sorted((r.id, r.load_date, r.source_file[-5:]) for r in rows.collect())
    assert shown == [(1, "20240101", "a.csv"), (1, "20240102", "c.csv"), (2, "20240101", "b.csv")]


def test_copies_are_merged_before_the_shuffle(spark, folder):
    put(folder, "particao_20240101", "a.csv", *[good(1)] * 50)
    plan = final_plan(take_in(spark, small(folder)))
    assert "partial_min" in plan.split("Exchange")[1]


def test_batch_day_replaces_the_folder_day(spark, folder):
    put(folder, "particao_20240101", "a.csv", good(1))
    put(folder, "particao_20240102", "a.csv", good(1))
    rows = take_in(spark, small(folder), load_date="20240109")
    assert tuples(rows, "id", "load_date") == [(1, "20240109")]


def test_client_file_under_its_own_header(spark, folder):
    header = (
        "cod_cliente,nm_cliente,nm_pais_cliente,nm_cidade_cliente,nm_rua_cliente,"
        "num_casa_cliente,telefone_cliente,dt_nascimento_cliente,dt_atualizacao,tp_pessoa,vl_renda"
    )
    line = "7,ana,BR,SP,Rua A,1,(11)99999-9999,1990-01-02,2024-01-01 10:00:00.123456,PF,10.555"
    put(folder, "particao_20240101", "a.csv", line, header=header)
    row = take_in(spark, Landing(folder)).first()
    assert (row.client_id, row.name, row.phone) == (7, "ANA", "(11)99999-9999")
    assert (row.birth_date, row.income) == (date(1990, 1, 2), Decimal("10.56"))
    assert row.updated_at.microsecond == 123456
    assert take_in(spark, Landing(folder)).columns[:11] == client_schema().names
