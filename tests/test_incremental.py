from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from medallion.operators.upsert import StateTable, rebuild, upsert
from medallion.quality import engine, rules
from medallion.quality.incremental import check_changes, checks, violations
from medallion.schema import DATE, LONG, MONEY, TEXT, TIME, struct
from medallion.sources import journal, tables

SCHEMA = struct(
    client_id=LONG, event_id=LONG, updated_at=TIME, kind=TEXT, income=MONEY, birth_date=DATE
)
DAY = datetime(2024, 1, 1)


def stamp():
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


class Checked:
    def __init__(self, spark, folder):
        self.spark, self.path = spark, folder + "/violations"
        self.table = StateTable(folder + "/table", SCHEMA, 4)

    def bring(self, *rows):
        events = [(c, n, DAY + timedelta(days=n), kind, income, None) for c, n, kind, income in rows]
        events = [(*e[:4], None if e[4] is None else Decimal(e[4]), e[5]) for e in events]
        upsert(self.spark, self.table, self.spark.createDataFrame(events, SCHEMA), "b", stamp())

    def check(self, run_date, *chosen):
        return check_changes(self.spark, self.table, chosen or [kinds(), rules.negative()], self.path, run_date)

    def found(self):
        rows = violations(self.spark, self.path, self.table).collect()
        return sorted((r.run_date, r.rule, r.client_id, r.updated_at.day) for r in rows)


def kinds(*allowed):
    return rules.category("kind", allowed or ("a", "b"))


KIND, NEGATIVE = "categorical_domain", "negative_salary"


@pytest.fixture
def checked(spark, folder):
    return Checked(spark, folder)


def test_only_new_versions_are_recorded(checked):
    checked.bring((1, 1, "x", 5), (2, 1, "a", -5), (3, 1, "x", -1))
    assert checked.check("20240101") == 4
    assert checked.check("20240102") == 0
    checked.bring((1, 4, "y", 5), (4, 4, "x", 5), (2, 1, "a", -5))
    assert checked.check("20240103") == 2
    assert checked.found() == [
        ("20240101", KIND, 1, 2), ("20240101", KIND, 3, 2),
        ("20240101", NEGATIVE, 2, 2), ("20240101", NEGATIVE, 3, 2),
        ("20240103", KIND, 1, 5), ("20240103", KIND, 4, 5),
    ]
    rows = checks(checked.spark, checked.path).collect()
    assert [(r.run_date, r.checked, r.rows) for r in rows] == [("20240101", 1, 4), ("20240102", 1, 0), ("20240103", 2, 2)]


def test_a_date_run_again_records_the_same(checked):
    checked.bring((1, 1, "x", 5), (2, 1, "x", 5))
    checked.check("20240101")
    checked.bring((1, 2, "y", 5), (3, 2, "x", 5))
    checked.check("20240102")
    before = checked.found()
    for run_date in ("20240102", "20240102", "20240101", "20240102"):
        checked.check(run_date)
    # The version of client 1 that the first date saw is gone by now.
    assert checked.found() == [row for row in before if row[:3] != ("20240101", KIND, 1)]
    checked.bring((2, 9, "z", 5))
    checked.check("20240102")
    assert ("20240102", KIND, 2, 10) in checked.found()
    assert checked.check("20240103") == 0


def test_a_rule_that_is_new_or_changed_looks_at_all_rows(checked):
    checked.bring((1, 1, "x", -5), (2, 1, "b", 5), (3, 1, "x", 5))
    checked.check("20240101", rules.negative())
    checked.bring((4, 2, "x", 5))
    assert checked.check("20240102", rules.negative(), kinds()) == 3
    # The same rule name with another setting: what is recorded is left out.
    assert checked.check("20240103", kinds("a")) == 1
    assert checked.found()[-1] == ("20240103", KIND, 2, 2)


def test_rules_that_are_not_settled_look_at_all_rows(checked):
    checked.bring((1, 1, "a", 10), (2, 1, "a", 10), (3, 1, "a", 16))

    def mean():
        return rules.mean_outlier(checked.table.read(checked.spark), "income", 1.25)

    assert checked.check("20240101", mean()) == 1
    checked.bring((4, 2, "a", 1), (5, 2, "a", 1))
    assert checked.check("20240102", mean(), rules.age_range(as_of="2024-01-02")) == 2
    assert checked.check("20240103", mean()) == 0
    assert {r[2] for r in checked.found()} == {1, 2, 3}


def test_a_reference_may_be_settled(checked):
    checked.bring((1, 1, "x", 1), (2, 1, "a", 1))
    known = checked.spark.createDataFrame([("a",)], "kind string")
    settled = rules.ReferenceRule(known, ("kind",), settled=True)
    assert checked.check("20240101", settled) == 1
    nothing = rules.ReferenceRule(known.limit(0), ("kind",), settled=True)
    assert checked.check("20240102", nothing) == 0
    assert checked.check("20240103", rules.ReferenceRule(known.limit(0), ("kind",))) == 1


def test_a_rebuild_records_nothing_twice(checked):
    rows = [(c, 1, "x", 1) for c in range(6)]
    checked.bring(*rows)
    checked.check("20240101")
    source = checked.table.read(checked.spark).where("client_id < 4")
    more = source.limit(1).withColumns({"client_id": F.lit(9).cast("bigint")})
    rebuild(checked.spark, checked.table, source.unionByName(more), "anew", stamp())
    assert checked.check("20240102") == 1
    assert checked.found()[-1][:3] == ("20240102", KIND, 9)


def test_a_run_that_dies_has_checked_nothing(checked, monkeypatch):
    checked.bring((1, 1, "x", 5))

    def dies(*_, **__):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables.journal, "add", dies)
        with pytest.raises(RuntimeError):
            checked.check("20240101")
    assert checked.found() == []
    assert checked.check("20240102") == 1


def test_the_future_date_rule_stays_settled_as_days_go_by(checked):
    checked.bring((1, 1, "a", 5))
    checked.check("20240101", rules.future_date(as_of="2024-01-01"))
    newest = journal.newest(checked.spark, f"{checked.path}/versions")
    checked.check("20240102", rules.future_date(as_of="2024-01-02"))
    assert journal.newest(checked.spark, f"{checked.path}/versions")["after"] == newest["after"]


def test_only_the_changed_layer_is_read(checked, monkeypatch):
    checked.bring(*[(c, 1, "x", 1) for c in range(40)])
    checked.check("20240101")
    checked.bring((1, 5, "y", 1))
    base, read = journal.newest(checked.spark, checked.table.journal)["base"], []
    run = engine.run

    def watched(df, *arguments, **named):
        read.append([f for f in df.inputFiles() if base in f])
        return run(df, *arguments, **named)

    monkeypatch.setattr(engine, "run", watched)
    assert checked.check("20240102") == 1
    assert read == [[]]


def test_any_sequence_of_batches_records_each_version_once(spark, tmp_path):
    dice = random.Random(11)
    for case in range(2):
        checked = Checked(spark, str(tmp_path / str(case)))
        newest, seen, want = {}, set(), []
        for day in range(1, 5):
            batch = [
                (dice.randrange(15), dice.randrange(25), dice.choice("abxy"), dice.choice((-1, 1)))
                for _ in range(dice.choice((2, 12)))
            ]
            batch = list({(c, n): (c, n, kind, income) for c, n, kind, income in batch}.values())
            batch = [e for e in batch if newest.get(e[0], (0, -1))[1] != e[1]]
            checked.bring(*batch)
            for c, n, kind, income in batch:
                if n > newest.get(c, (0, -1))[1]:
                    newest[c] = (c, n, kind, income)
            run_date = f"2024010{day}"
            for c, n, kind, income in newest.values():
                for rule, broken in ((KIND, kind in "xy"), (NEGATIVE, income < 0)):
                    if broken and (rule, c, n) not in seen:
                        seen.add((rule, c, n))
                        want.append((run_date, rule, c, (DAY + timedelta(days=n)).day))
            checked.check(run_date)
        assert checked.found() == sorted(want)


def test_no_rules_are_an_error(checked):
    checked.bring((1, 1, "x", 5))
    with pytest.raises(ValueError, match="no rules"):
        check_changes(checked.spark, checked.table, [], checked.path, "20240101")
