from __future__ import annotations

import json
import random
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators import sums
from medallion.operators.sums import SumTable
from medallion.operators.upsert import StateTable, rebucket, rebuild, upsert, vacuum
from medallion.plans import report
from medallion.quality import engine, rules
from medallion.schema import LONG, MONEY, TEXT, TIME, struct
from medallion.sources import journal
from tests.conftest import tuples

SCHEMA = struct(
    client_id=LONG, event_id=LONG, updated_at=TIME, country=TEXT, income=MONEY, deleted=T.BooleanType()
)
DAY = datetime(2024, 1, 1)


def stamp():
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


def event(client, day, country="BR", income=1, deleted=False):
    return (client, client * 100 + day, DAY + timedelta(days=day), country, None if income is None else Decimal(income), deleted)


class Kept:
    def __init__(self, spark, folder):
        self.spark = spark
        self.table = StateTable(folder + "/table", SCHEMA, 4, feed=("country", "income", "deleted"))
        total = {"income": ("income", T.DecimalType(28, 2))}
        self.gold = SumTable(folder + "/gold", self.table, ("country",), total, "NOT deleted")

    def bring(self, *events):
        upsert(self.spark, self.table, self.spark.createDataFrame(list(events), SCHEMA), "b", stamp())

    def refresh(self):
        return sums.refresh(self.spark, self.gold)

    def rows(self):
        return tuples(self.gold.read(self.spark, "clients"))

    def recomputed(self):
        living = self.table.read(self.spark).where("NOT deleted")
        return tuples(living.groupBy("country").agg(
            F.count("*").alias("clients"), F.sum(F.col("income").cast("decimal(28,2)")).alias("income")
        ))


@pytest.fixture
def kept(spark, folder):
    return Kept(spark, folder)


def test_inserts_updates_deletes_and_late_events(kept):
    kept.bring(event(1, 1, "BR", 10), event(2, 1, "BR", None), event(3, 1, "PT", 5), event(4, 1, None, 7))
    assert kept.refresh() and kept.rows() == kept.recomputed()
    assert ("BR", 2, Decimal("10.00")) in kept.rows()
    kept.bring(event(1, 3, "PT", 20), event(2, 2, "BR", 4), event(3, 2, "PT", 5, True), event(4, 0, "XX", 9))
    assert kept.refresh() and kept.rows() == kept.recomputed()
    assert dict((r[0], r[1:]) for r in kept.rows()) == {
        "BR": (1, Decimal("4.00")), "PT": (1, Decimal("20.00")), None: (1, Decimal("7.00")),
    }
    kept.bring(event(2, 3, "BR", 4, True), event(1, 2, "BR", 1))
    assert kept.refresh()
    assert [r[0] for r in kept.rows()] == [None, "PT"] or [r[0] for r in kept.rows()] == ["PT", None]


def test_several_batches_at_once_and_none(kept):
    for day in range(3):
        kept.bring(*[event(c, day, f"C{(c + day) % 3}", c + day) for c in range(day, 20)])
    assert kept.refresh() and kept.rows() == kept.recomputed()
    before = journal.newest(kept.spark, kept.gold.journal)
    assert kept.refresh() and journal.newest(kept.spark, kept.gold.journal) == before
    kept.bring(*[event(c, 0, "late") for c in range(5, 9)])  # nothing wins
    assert kept.refresh() and kept.rows() == kept.recomputed()


def test_a_group_of_nulls_has_no_sum(kept):
    kept.bring(event(1, 1, "BR", None), event(2, 1, "BR", 3))
    kept.refresh()
    kept.bring(event(2, 2, "PT", 3))
    kept.refresh()
    assert kept.rows() == [("BR", 1, None), ("PT", 1, Decimal("3.00"))] == kept.recomputed()


def test_the_table_is_read_when_it_was_made_anew(spark, kept):
    kept.bring(*[event(c, 1) for c in range(8)])
    kept.refresh()
    rebucket(spark, replace(kept.table, buckets=3), "wider", stamp())
    assert kept.refresh()
    kept.table = replace(kept.table, buckets=3)
    kept.gold = replace(kept.gold, table=kept.table)
    rebuild(spark, kept.table, kept.table.read(spark).where("client_id < 3"), "anew", stamp())
    assert not kept.refresh() and kept.rows() == kept.recomputed() == [("BR", 3, Decimal("3.00"))]
    kept.bring(event(1, 5, "PT"))
    vacuum(spark, kept.table, fed_to=kept.table.version(spark))
    assert not kept.refresh() and kept.rows() == kept.recomputed()


def test_the_feed_alone_is_read(kept):
    kept.bring(*[event(c, 1) for c in range(40)])
    kept.refresh()
    kept.bring(event(3, 2, "PT"), event(50, 1))
    runs = [journal.newest(kept.spark, kept.table.journal)["feed"]]
    before, after = kept.table.feed_rows(kept.spark, runs)
    assert tuples(before) == [("BR", Decimal("1.00"), False)]
    assert tuples(after, "country") == [("BR",), ("PT",)]
    parts = [sums.contributions(before, kept.gold, -1), sums.contributions(after, kept.gold)]
    plan = sums.added_up(parts, kept.gold)._jdf.queryExecution().optimizedPlan().toString()
    assert "state_" not in plan and kept.table.path + "/data" not in plan


def test_a_run_that_dies_adds_nothing(kept, monkeypatch):
    kept.bring(*[event(c, 1) for c in range(5)])
    kept.refresh()
    kept.bring(event(1, 2, "PT"))
    before = kept.rows()

    def dies(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(sums.journal, "add", dies)
        with pytest.raises(RuntimeError):
            kept.refresh()
    assert kept.rows() == before
    kept.refresh()
    assert kept.rows() == kept.recomputed()


def test_a_group_with_most_of_the_rows(spark, folder):
    kept = Kept(spark, folder)
    rows = spark.range(0, 30_000, 1, 8).select(
        F.col("id").alias("client_id"), F.col("id").alias("event_id"),
        F.lit(str(DAY)).cast("timestamp_ntz").alias("updated_at"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("C"), F.col("id") % 7)).otherwise("hot").alias("country"),
        F.lit(2).cast("decimal(10,2)").alias("income"), F.lit(False).alias("deleted"),
    )
    upsert(spark, kept.table, rows, "all", stamp())
    kept.refresh()
    assert kept.rows() == kept.recomputed() and kept.rows()[-1][1] == 20_000


@pytest.mark.parametrize("kind", ["decimal(10,2)", "decimal(38,0)", "decimal(38,19)"])
def test_mean_from_kept_sums_is_that_of_a_scan(spark, folder, kind):
    dice = random.Random(3)
    scale = T._parse_datatype_string(kind).scale
    schema = struct(client_id=LONG, event_id=LONG, updated_at=TIME, income=T._parse_datatype_string(kind))
    table = StateTable(folder + "/table", schema, 3, feed=("income",))
    parts = report.mean_parts_of(table, folder + "/parts")
    for day in range(3):
        digits = T._parse_datatype_string(kind).precision
        rows = [
            (c, day, DAY + timedelta(days=day),
             dice.choice([None, Decimal(dice.randrange(-(10 ** (digits - 1)), 10**digits)).scaleb(-scale)]) if day else None)
            for c in range(12)
        ]
        text = spark.createDataFrame(
            [(c, n, t, None if v is None else format(v, "f")) for c, n, t, v in rows],
            "client_id long, event_id long, updated_at timestamp_ntz, income string",
        )
        upsert(spark, table, text.withColumn("income", F.col("income").cast(kind)), "b", stamp())
        assert sums.refresh(spark, parts)
        kept, silver = parts.read(spark), table.read(spark)
        for multiplier in (0.5, 1.0, 1.25):
            scanned = engine.check_rows(silver, [rules.mean_outlier(silver, "income", multiplier)])
            known = engine.check_rows(
                silver, [rules.mean_outlier_of_sums(kept, "income", schema["income"].dataType, multiplier)]
            )
            assert tuples(known) == tuples(scanned)
            for row in known.collect():
                assert json.loads(row.rule_params)["multiplier"] == multiplier


def test_mean_of_an_empty_table(spark, folder):
    table = StateTable(folder + "/table", SCHEMA, 3, feed=("income",))
    parts = report.mean_parts_of(table, folder + "/parts")
    sums.refresh(spark, parts)
    rule = rules.mean_outlier_of_sums(parts.read(spark), "income", SCHEMA["income"].dataType)
    some = spark.createDataFrame([event(1, 1)], SCHEMA)
    assert engine.check_rows(some, [rule]).count() == 0
