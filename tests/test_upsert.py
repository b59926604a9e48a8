from __future__ import annotations

import glob
import os
import random
import uuid
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from medallion.operators import upsert as module
from medallion.operators.dedupe import latest_per_key
from medallion.operators.upsert import (
    StateTable,
    last_operation,
    operations,
    rebucket,
    rebuild,
    upsert,
    vacuum,
)
from medallion.schema import LONG, TEXT, TIME, struct
from medallion.sources import journal
from tests.conftest import final_plan, tuples

SCHEMA = struct(client_id=LONG, event_id=LONG, updated_at=TIME, kind=TEXT, phone=TEXT)
DAY = datetime(2024, 1, 1)


def event(client, number, day, kind="a", phone="p"):
    return (client, number, DAY + timedelta(days=day), kind, phone)


class Lake:
    def __init__(self, spark, folder, buckets=4):
        self.spark = spark
        self.table = StateTable(folder + "/table", SCHEMA, buckets)
        self.batches = 0

    def bring(self, *events, batch=None, compare=()):
        self.batches += 1
        source = self.spark.createDataFrame(list(events), SCHEMA)
        name = batch or f"b{self.batches}"
        return upsert(self.spark, self.table, source, name, self.stamp(), compare).first()

    def stamp(self):
        return F.lit(str(DAY + timedelta(days=self.batches))).cast("timestamp_ntz")

    def rows(self):
        return tuples(self.table.read(self.spark))


@pytest.fixture
def lake(spark, folder):
    return Lake(spark, folder)


def counts(audit):
    return {name: audit[name] for name in ("inserted", "updated", "unchanged", "stale")}


def test_first_batch_is_inserted(lake):
    audit = lake.bring(event(1, 1, 0), event(1, 2, 0, "b"), event(2, 3, 1))
    assert lake.rows() == [event(1, 2, 0, "b"), event(2, 3, 1)]
    assert counts(audit) == {"inserted": 2, "updated": 0, "unchanged": 0, "stale": 0}


def test_newer_rows_win_and_older_ones_lose(lake):
    lake.bring(event(1, 1, 5), event(2, 2, 5), event(3, 3, 5))
    audit = lake.bring(event(1, 4, 6, "new"), event(2, 5, 4, "old"), event(4, 6, 0))
    assert lake.rows() == [event(1, 4, 6, "new"), event(2, 2, 5), event(3, 3, 5), event(4, 6, 0)]
    assert counts(audit) == {"inserted": 1, "updated": 1, "unchanged": 0, "stale": 1}


def test_equal_times_are_decided_by_event_number(lake):
    lake.bring(event(1, 7, 5, "seven"))
    assert counts(lake.bring(event(1, 6, 5, "six")))["stale"] == 1
    assert counts(lake.bring(event(1, 8, 5, "eight")))["updated"] == 1
    assert lake.rows() == [event(1, 8, 5, "eight")]


def test_a_batch_brought_in_again_changes_nothing(lake):
    batch = [event(c, c * 10 + n, n) for c in range(6) for n in range(3)]
    lake.bring(*batch)
    before = lake.rows()
    assert counts(lake.bring(*batch)) == {"inserted": 0, "updated": 0, "unchanged": 6, "stale": 0}
    assert lake.rows() == before


def test_an_event_without_a_key_stops_the_run(lake):
    lake.bring(event(1, 1, 0))
    with pytest.raises(Exception, match="event without a key"):
        lake.bring(event(2, 2, 0), event(None, 3, 0))
    assert lake.rows() == [event(1, 1, 0)]


def test_any_split_into_batches_gives_the_same_table(spark, tmp_path):
    dice = random.Random(5)
    events = [
        event(dice.randrange(12), n, dice.randrange(6), dice.choice("abc"), dice.choice("pq"))
        for n in range(60)
    ]
    newest = {}
    for e in events:
        if e[0] not in newest or (e[2], e[1]) > (newest[e[0]][2], newest[e[0]][1]):
            newest[e[0]] = e
    for compare in ((), ("kind",)):
        for number in range(2):
            dice.shuffle(events)
            cut = sorted(dice.sample(range(1, 60), 2))
            lake = Lake(spark, str(tmp_path / f"{number}{compare}"))
            for part in (events[: cut[0]], events[cut[0] : cut[1]], events[cut[1] :]):
                lake.bring(*part, compare=compare)
            assert lake.rows() == sorted(newest.values(), key=repr)


def test_a_client_with_a_third_of_all_events(spark, folder):
    lake = Lake(spark, folder, buckets=8)
    number = F.col("id")
    events = spark.range(0, 60_000, 1, 8).select(
        F.when(number % 3 == 0, 0).otherwise(number % 5000).cast("bigint").alias("client_id"),
        number.alias("event_id"),
        F.lit(str(DAY)).cast("timestamp_ntz").alias("updated_at"),
        number.cast("string").alias("kind"),
        F.lit("p").alias("phone"),
    )
    stamp = F.lit(str(DAY)).cast("timestamp_ntz")
    audit = upsert(spark, lake.table, events, "all", stamp).first()
    newest = {}
    for n in range(60_000):
        newest[0 if n % 3 == 0 else n % 5000] = n
    assert audit.inserted == len(newest)
    assert {row[0]: row[1] for row in lake.rows()} == newest


def test_only_changes_of_the_compared_columns_count(lake):
    lake.bring(event(1, 1, 1, "a", "p"), event(2, 2, 1, "a", "p"))
    audit = lake.bring(event(1, 3, 5, "a", "q"), event(2, 4, 5, "b", "q"), compare=("kind",))
    assert counts(audit) == {"inserted": 0, "updated": 1, "unchanged": 1, "stale": 0}
    # The table follows the newer event all the same.
    assert lake.rows() == [event(1, 3, 5, "a", "q"), event(2, 4, 5, "b", "q")]
    assert counts(lake.bring(event(1, 9, 3, "z"), compare=("kind",)))["stale"] == 1


def test_compared_nulls_are_equal(lake):
    lake.bring(event(1, 1, 1, None))
    assert counts(lake.bring(event(1, 2, 2, None), compare=("kind",)))["unchanged"] == 1
    assert counts(lake.bring(event(1, 3, 3, "a"), compare=("kind",)))["updated"] == 1


def rows_written(table):
    """Counts the rows of the data files written from now on."""
    before = set(glob.glob(f"{table.path}/data/**/*.parquet", recursive=True))

    def new():
        files = set(glob.glob(f"{table.path}/data/**/*.parquet", recursive=True)) - before
        return sum(pq.read_metadata(f).num_rows for f in files)

    return new


def entry(spark, table):
    return journal.newest(spark, table.journal)


def test_small_batches_leave_the_base_alone(spark, lake):
    lake.bring(*[event(c, c, 0) for c in range(400)])
    base = entry(spark, lake.table)["base"]
    written, rows = rows_written(lake.table), dict((e[0], e) for e in lake.rows())
    for number in range(3):
        batch = [event(c, 1000 + c, 9 + number, "new") for c in range(number, 12 * number + 3)]
        batch += [event(400 + number, 1, 1)]
        audit = lake.bring(*batch)
        rows.update((e[0], e) for e in batch)
        assert (audit.inserted, audit.updated) == (1, len(batch) - 1)
        assert audit.kept == 400 + number - audit.updated
        assert entry(spark, lake.table)["base"] == base
        assert lake.rows() == sorted(rows.values(), key=repr)
    # Each run wrote the rows changed since the base, 4 and 17 and 30 of them.
    assert written() == 4 + 17 + 30


def test_many_changes_become_a_new_base(spark, lake):
    lake.bring(*[event(c, c, 0) for c in range(40)])
    base = entry(spark, lake.table)["base"]
    lake.bring(*[event(c, 100 + c, 1) for c in range(8)])
    assert (entry(spark, lake.table)["base"], entry(spark, lake.table)["changed_rows"]) == (base, 8)
    written = rows_written(lake.table)
    lake.bring(*[event(c, 200 + c, 2) for c in range(6, 15)])
    now = entry(spark, lake.table)
    assert now["base"] != base and now["changes"] is None and written() == 40
    want = {c: event(c, c, 0) for c in range(40)}
    want |= {c: event(c, 100 + c, 1) for c in range(8)} | {c: event(c, 200 + c, 2) for c in range(6, 15)}
    assert lake.rows() == sorted(want.values(), key=repr)


def test_a_stale_batch_writes_nothing(spark, lake):
    lake.bring(*[event(c, 100 + c, 5) for c in range(40)])
    lake.bring(event(3, 500, 9))
    before, written = entry(spark, lake.table), rows_written(lake.table)
    audit = lake.bring(*[event(c, c, 4) for c in range(40)])
    assert counts(audit) == {"inserted": 0, "updated": 0, "unchanged": 0, "stale": 40}
    after = entry(spark, lake.table)
    assert written() == 0 and (after["base"], after["changes"]) == (before["base"], before["changes"])


def test_rows_changed_since_a_version(spark, lake):
    lake.bring(*[event(c, c, 0) for c in range(40)])
    lake.bring(event(1, 100, 1), event(2, 1, -5), event(50, 3, 0))
    lake.bring(event(1, 101, 2), event(3, 102, 2))
    def changed(version):
        return tuples(lake.table.changed_since(spark, version), "client_id", "_version")

    assert changed(3) == [] and changed(2) == [(1, 3), (3, 3)]
    assert changed(1) == [(1, 3), (3, 3), (50, 2)]
    assert len(changed(0)) == 41 and lake.table.version(spark) == 3
    plan = lake.table.changed_since(spark, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert entry(spark, lake.table)["base"] not in plan
    lake.bring(*[event(c, 200 + c, 3) for c in range(30)])
    assert changed(3) == [(c, 4) for c in sorted(range(30), key=lambda c: repr((c, 4)))]


def test_layers_are_found_by_another_session(spark, lake):
    lake.bring(*[event(c, c, 0) for c in range(40)])
    lake.bring(event(1, 100, 1))
    now, before = entry(spark, lake.table), lake.rows()
    for run in (now["base"], now["changes"]):
        spark.sql(f"DROP TABLE state_{run}")
    assert lake.rows() == before
    lake.bring(event(2, 100, 1))
    assert len(lake.rows()) == 40


def test_catalog_shows_the_newest_version(spark, lake):
    name = f"v_{uuid.uuid4().hex}"
    lake.table.register(spark, name)
    assert spark.table(name).collect() == [] and spark.table(name).columns == SCHEMA.names
    for batch in ([event(c, c, 0) for c in range(40)], [event(1, 100, 1)]):
        lake.bring(*batch)
        lake.table.register(spark, name)
        assert tuples(spark.table(name)) == lake.rows()
    vacuum(spark, lake.table)
    assert tuples(spark.table(name)) == lake.rows()


def test_another_bucket_count_is_noticed(spark, folder, lake):
    lake.bring(*[event(c, c, 0) for c in range(40)])
    with pytest.raises(Exception, match="not written with 8 buckets"):
        Lake(spark, folder, buckets=8).bring(*[event(c, 100 + c, 9) for c in range(40)])
    assert len(lake.rows()) == 40


def test_a_run_that_dies_leaves_the_table_as_it_was(spark, lake, monkeypatch):
    lake.bring(*[event(c, c, 0) for c in range(10)])
    before = lake.rows()

    def dies(*_):
        raise RuntimeError("driver lost")

    for step in ("_counts", "journal.add"):
        with monkeypatch.context() as patch:
            patch.setattr(f"medallion.operators.upsert.{step}", dies)
            with pytest.raises(RuntimeError):
                lake.bring(*[event(c, 100 + c, 1, "second") for c in range(10)], batch="second")
        assert lake.rows() == before
    audit = lake.bring(event(3, 200, 2, "third"))
    assert (audit.version, audit.updated) == (2, 1)
    assert lake.rows() == sorted([e for e in before if e[0] != 3] + [event(3, 200, 2, "third")], key=repr)


def test_of_two_writers_one_fails(spark, lake, monkeypatch):
    lake.bring(event(1, 1, 0))
    counts_of, inside = module._counts, []

    def overtaken(*arguments):
        if not inside:
            inside.append(True)
            lake.bring(event(1, 2, 2, "other"), event(5, 5, 2))
        return counts_of(*arguments)

    monkeypatch.setattr(module, "_counts", overtaken)
    with pytest.raises(journal.ConcurrentWrite):
        lake.bring(event(1, 3, 1, "slow"))
    assert lake.rows() == [event(1, 2, 2, "other"), event(5, 5, 2)]
    assert operations(spark, lake.table).count() == 2


def test_a_reader_keeps_the_version_it_found(spark, lake):
    lake.bring(event(1, 1, 0), event(2, 2, 0))
    reader = lake.table.read(spark)
    lake.bring(event(1, 3, 1, "new"))
    assert tuples(reader) == [event(1, 1, 0), event(2, 2, 0)]


def test_vacuum_deletes_what_no_version_names(spark, lake):
    for number in range(3):
        lake.bring(*[event(c, 10 * number + c, number) for c in range(20)])
    before = lake.rows()
    vacuum(spark, lake.table)
    assert lake.rows() == before
    assert len(os.listdir(lake.table.path + "/data")) == 1
    assert os.listdir(lake.table.path + "/work") == []


def test_rebuild_forgets_what_the_source_lacks(spark, folder, lake):
    lake.bring(*[event(c, c, 0) for c in range(20)])
    source = spark.createDataFrame([event(1, 1, 0), event(1, 50, 1, "b"), event(30, 2, 0)], SCHEMA)
    wider = Lake(spark, folder, buckets=9)
    audit = rebuild(spark, wider.table, source, "all", lake.stamp()).first()
    assert wider.rows() == [event(1, 50, 1, "b"), event(30, 2, 0)]
    assert (audit.version, audit.operation, audit.inserted) == (2, "rebuild", 2)


def test_another_number_of_buckets(spark, folder, lake):
    lake.bring(*[event(c, c, 0) for c in range(40)])
    before = lake.rows()
    wider = Lake(spark, folder, buckets=11)
    audit = rebucket(spark, wider.table, "wider", lake.stamp()).first()
    assert (audit.operation, audit.kept) == ("rebucket", 40)
    assert wider.rows() == before and entry(spark, wider.table)["buckets"] == 11
    wider.bring(event(3, 100, 9))
    assert len(wider.rows()) == 40


def test_an_empty_batch_is_an_operation_too(spark, lake):
    assert lake.bring().inserted == 0 and lake.rows() == []
    lake.bring(event(1, 1, 0))
    assert counts(lake.bring()) == {"inserted": 0, "updated": 0, "unchanged": 0, "stale": 0}
    assert lake.rows() == [event(1, 1, 0)]


def test_last_operation_is_the_latest_batch(spark, lake):
    assert last_operation(spark, lake.table).count() == 0
    lake.bring(event(1, 1, 0))
    lake.bring(event(1, 2, 1), event(2, 3, 1))
    last = last_operation(spark, lake.table).first()
    assert (last.version, last.batch_id, last.operation) == (2, "b2", "upsert")
    assert last.run_ts == DAY + timedelta(days=2)
    assert counts(last) == {"inserted": 1, "updated": 1, "unchanged": 0, "stale": 0}


def below_scan(plan, run):
    """The lines of the plan from its root down to the scan of that layer."""
    lines = plan.split("== Initial Plan ==")[0].splitlines()
    at = next(i for i, line in enumerate(lines) if f"state_{run}" in line)
    depth, path = lines[at].index("F"), []
    for line in reversed(lines[: at + 1]):
        start = min((i for i, c in enumerate(line) if c.isalpha() or c == "*"), default=0)
        if start < depth or line is lines[at]:
            path.append(line)
            depth = min(depth, start)
    return path


def test_no_row_of_the_table_is_shuffled(spark, lake):
    """Judging a batch, and writing both kinds of layers, exchange the batch alone."""
    lake.bring(*[event(c, c, 0) for c in range(400)])
    lake.bring(event(1, 500, 1))
    now = entry(spark, lake.table)
    batch = spark.createDataFrame([event(2, 600, 2), event(900, 1, 1)], SCHEMA)
    winners = batch.withColumn("_version", F.lit(3).cast("bigint"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changes, base = (lake.table._layer(spark, now, name) for name in ("changes", "base"))
        over = module.lay_over(changes, winners, lake.table)
        for df in (
            module.judge(batch, [changes, base], lake.table),
            module.lay_over(base, over, lake.table),
        ):
            plan = final_plan(df)
            assert plan.split("== Initial Plan ==")[0].count("Exchange") > 0
            for name in ("base",) if df is not over else ("changes",):
                path = below_scan(plan, now[name])
                assert "Bucketed: true" in path[0] and not any("Exchange" in line for line in path)
        path = below_scan(final_plan(over), now["changes"])
        assert "Bucketed: true" in path[0] and not any("Exchange" in line for line in path)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_judging_reads_order_columns_only(spark, lake):
    lake.bring(*[event(c, c, 0) for c in range(40)])
    base = lake.table._layer(spark, entry(spark, lake.table), "base")
    batch = spark.createDataFrame([event(2, 600, 2)], SCHEMA)
    plan = final_plan(module.judge(batch, [base], lake.table))
    assert "ReadSchema: struct<client_id:bigint,event_id:bigint,updated_at:timestamp_ntz>" in plan


def test_rows_without_a_time_are_the_oldest(lake):
    lake.bring((1, 1, None, "a", "p"), event(2, 2, 1))
    audit = lake.bring(event(1, 0, 0, "b"), (2, 9, None, "c", "p"))
    assert counts(audit) == {"inserted": 0, "updated": 1, "unchanged": 0, "stale": 1}
    assert lake.rows() == [event(1, 0, 0, "b"), event(2, 2, 1)]


def test_latest_drops_old_versions_before_the_shuffle(spark):
    df = spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("client_id"),
        F.col("id").alias("updated_at"),
    )
    latest = latest_per_key(df, "client_id", ["updated_at"])
    final = final_plan(latest).split("== Initial Plan ==")[0]
    before_shuffle = final.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert latest.where("client_id = 0").first().updated_at == 2997
    assert latest.count() == 2001
