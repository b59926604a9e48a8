"""Keyed latest-wins upsert into a table that is clustered by its key.

The table has one or two layers, each a bucketed Parquet table: the base, and over it the rows
that changed since the base was written. Spark knows how both are clustered, so a join with a
batch moves the batch alone. A batch goes in four steps:

1. the batch, reduced to the newest row per key, is written to a work folder;
2. each of its rows is judged against the key and order columns of the row that the table holds;
3. rows that win are laid over the changed ones, which are written anew; once these are more
   than ``fold`` of the table, a new base is written instead;
4. one new journal entry, with the counts per action, names the layers.

So a batch costs its own size and that of the changed rows, not that of the table; a batch that
wins nothing writes nothing. Readers follow the entry they found and never see half a batch. A
run that dies leaves files that no entry names and nobody reads. Of two writers that start from
the same version the first to make its entry wins, and the other one's run fails without effect.
``vacuum`` deletes the folders that the newest version does not name.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.dedupe import latest_per_key
from medallion.schema import LONG, TEXT, TIME, struct
from medallion.sources import files, journal

# The version in which a row came to be as it is.
VERSION = "_version"
ACTION, WINS, HELD = "_action", "_wins", "_held"
BEFORE, AFTER = "_before", "_after"
ACTIONS = ("inserted", "updated", "unchanged", "stale", "kept")
OPERATION = struct(
    version=LONG,
    batch_id=TEXT,
    run_ts=TIME,
    operation=TEXT,
    **dict.fromkeys(ACTIONS, LONG),
)
# Operations that leave every row as it is.
KEEPS_ROWS = ("rebucket",)
# Events are late if they are older than the horizon of the table, if it has one.
EMPTY = {
    "version": 0,
    "base": None,
    "changes": None,
    "base_version": 0,
    "rows": 0,
    "changed_rows": 0,
    "horizon": None,
}
TOO_LATE = "too_late"


@dataclass(frozen=True)
class StateTable:
    """A one-row-per-key table.

    Choose ``buckets`` so that one is a task's work (a few hundred MB); ``rebucket`` changes it.
    ``fold`` is the share of the rows that may lie in the changed layer: more make small batches
    cheaper, and reading dearer. ``feed`` are columns of which each batch keeps the values of
    changed rows before and after.
    """

    path: str
    schema: T.StructType
    buckets: int
    key: str = "client_id"
    order: Sequence[str] = ("updated_at", "event_id")
    fold: float = 0.25
    feed: Sequence[str] = ()

    @property
    def journal(self) -> str:
        return f"{self.path}/versions"

    @property
    def stored_schema(self) -> T.StructType:
        return T.StructType(self.schema.fields + [T.StructField(VERSION, LONG)])

    def folder(self, run: str) -> str:
        return f"{self.path}/data/run={run}"

    def version(self, spark: SparkSession) -> int:
        """The newest version; 0 before the first batch."""
        return (journal.newest(spark, self.journal) or EMPTY)["version"]

    def read(self, spark: SparkSession) -> DataFrame:
        return self.rows(spark).drop(VERSION)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The rows with the version that each is from."""
        return self._rows(spark, journal.newest(spark, self.journal) or EMPTY)

    def changed_since(self, spark: SparkSession, version: int) -> DataFrame:
        """Of the rows, with their versions, those that came in after that version.

        The base is read only if it was written after it.
        """
        now = journal.newest(spark, self.journal) or EMPTY
        return self._rows(spark, now, version).where(F.col(VERSION) > version)

    def _rows(self, spark: SparkSession, now: dict, since: int = 0) -> DataFrame:
        layers = [self._layer(spark, now, name) for name in ("base", "changes") if now[name]]
        if len(layers) == 2 and now["base_version"] <= since:
            return layers[1]
        if len(layers) == 2:
            base, changes = layers
            return base.join(changes.select(self.key), self.key, "left_anti").unionByName(changes)
        return layers[0] if layers else spark.createDataFrame([], self.stored_schema)

    def late_folder(self, run: str) -> str:
        return f"{self.path}/late/run={run}"

    def feed_folder(self, run: str) -> str:
        return f"{self.path}/feed/run={run}"

    def feed_rows(self, spark: SparkSession, runs: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """The feed of those runs: changed rows as they were before, and as they are after."""
        values = T.StructType([self.schema[name] for name in self.feed])
        schema = T.StructType([T.StructField(side, values) for side in (BEFORE, AFTER)])
        if not runs:
            empty = spark.createDataFrame([], values)
            return empty, empty
        rows = spark.read.schema(schema).parquet(*map(self.feed_folder, runs))
        before, after = (rows.where(F.col(s).isNotNull()).select(f"{s}.*") for s in (BEFORE, AFTER))
        return before, after

    def register(self, spark: SparkSession, name: str) -> None:
        """Make the newest version known to the catalog as a view, in one statement."""
        now = journal.newest(spark, self.journal) or EMPTY
        columns = ", ".join(f"`{c}`" for c in self.schema.names)
        if not now["base"]:
            nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in self.schema)
            query = f"SELECT {nothing} WHERE false"
        else:
            for layer in ("base", "changes"):
                if now[layer]:
                    self._layer(spark, now, layer)
            query = f"SELECT {columns} FROM {_name(now['base'])}"
            if now["changes"]:
                over = _name(now["changes"])
                query += f" LEFT ANTI JOIN {over} USING (`{self.key}`) UNION ALL SELECT {columns} FROM {over}"
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")

    def _layer(self, spark: SparkSession, now: dict, layer: str) -> DataFrame:
        return self._bucketed(spark, _name(now[layer]), self.folder(now[layer]), now["buckets"])

    def _bucketed(self, spark: SparkSession, name: str, folder: str, buckets: int) -> DataFrame:
        # Only the catalog can tell Spark that files are clustered. An entry is made by whoever
        # needs it, so that it does not matter whether the catalog outlives the session.
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.stored_schema)
        where = folder.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) "
            f"SORTED BY (`{self.key}`) INTO {buckets} BUCKETS LOCATION '{where}'"
        )
        return spark.table(name)


def _name(run: str) -> str:
    return f"state_{run}"


def _side(names: Sequence[str], inside: str | None = None) -> Column:
    # Structs compare field by field, and null is smaller than any value.
    return F.struct(*[F.col(inside)[name] if inside else F.col(name) for name in names])


def judge(
    batch: DataFrame, layers: Sequence[DataFrame], table: StateTable, compare: Sequence[str] = ()
) -> DataFrame:
    """The rows of the batch, with the action that each takes and whether it wins.

    ``layers`` are the table's, the upper one first; what they hold counts from the first that
    has the key. The newer row wins, the one in the table if neither is newer. With ``compare``,
    a newer row that agrees in those columns counts as unchanged; it wins all the same.

    Of the layers only key, order and compared columns of the batch's keys are looked at, where
    they lie.
    """
    named = dict.fromkeys([*table.order, *compare, *table.feed])
    keys = batch.select(table.key)
    sides = batch
    for number, layer in enumerate(layers):
        held = layer.select(table.key, F.struct(*named).alias(f"{HELD}{number}"))
        sides = sides.join(held.join(keys, table.key, "left_semi"), table.key, "left")
    found = [F.col(f"{HELD}{number}") for number in range(len(layers))]
    sides = sides.withColumn(HELD, F.coalesce(*found) if found else F.lit(None))
    before = [] if not table.feed else [BEFORE]
    if not found:
        nothing = F.lit(None).cast(T.StructType([table.schema[name] for name in table.feed]))
        fed = {BEFORE: nothing for _ in before}
        return sides.withColumns({ACTION: F.lit("inserted"), WINS: F.lit(True), **fed}).drop(HELD)
    held, offered = _side(table.order, HELD), _side(table.order)
    new = F.col(HELD).isNull()
    action = F.when(new, "inserted").when(held > offered, "stale")
    action = action.when(held.eqNullSafe(offered), "unchanged")
    if compare:
        action = action.when(_side(compare).eqNullSafe(_side(compare, HELD)), "unchanged")
    judged = sides.withColumns({ACTION: action.otherwise("updated"), WINS: new | (held < offered)})
    if before:
        judged = judged.withColumn(BEFORE, F.when(~new, _side(table.feed, HELD)))
    return judged.drop(HELD, *[f"{HELD}{number}" for number in range(len(layers))])


def lay_over(lower: DataFrame, upper: DataFrame, table: StateTable) -> DataFrame:
    """All rows of ``upper``, and those of ``lower`` whose key it lacks. Clustered sides are
    joined where they lie."""
    rest = [name for name in table.stored_schema.names if name != table.key]
    below = lower.select(table.key, F.struct(*rest).alias("_below"))
    above = upper.select(table.key, F.struct(*rest).alias("_above"))
    taken = F.coalesce("_above", "_below")
    both = below.join(above, table.key, "full_outer").select(table.key, taken.alias("_taken"))
    return both.select(table.key, "_taken.*").select(*table.stored_schema.names)


def upsert(
    spark: SparkSession,
    table: StateTable,
    source: DataFrame,
    batch_id: str,
    run_ts: Column,
    compare: Sequence[str] = (),
) -> DataFrame:
    """Bring a batch of events into the table and return its audit row.

    ``source`` may hold many events per key, in any order, also older than the table's;
    an event without a key stops the run. The result does not depend on how the
    events were split into batches, and a batch brought in twice changes nothing. After a
    ``purge`` events older than its horizon are not taken in, see ``late_events``.
    """
    now, run = _present(spark, table), uuid.uuid4().hex
    work = f"{table.path}/work/run={run}"
    late = None
    if now["horizon"]:
        old = _older(table, now["horizon"])
        late = _keep_late(source.where(old).select(*table.schema.names), table.late_folder(run), run)
        source = source.where(~old)
    batch = _newest(spark, table, source, f"{work}/batch")
    layers = [table._layer(spark, now, name) for name in ("changes", "base") if now[name]]
    judged = judge(batch, layers, table, compare).withColumn(VERSION, F.lit(now["version"] + 1).cast("bigint"))
    judged.write.parquet(f"{work}/judged")
    judged = spark.read.schema(judged.schema).parquet(f"{work}/judged")
    counts = _counts(judged)
    won = counts.pop("won")
    entry = {**now, "rows": now["rows"] + counts["inserted"], "won": won, "feed": None, "late": late}
    if won and table.feed:
        fed = judged.where(WINS).select(BEFORE, _side(table.feed).alias(AFTER))
        fed.write.parquet(table.feed_folder(run))
        entry["feed"] = run
    winners = judged.where(WINS).select(*table.stored_schema.names)
    if won and won + now["changed_rows"] <= table.fold * now["rows"]:
        changed = lay_over(layers[0], winners, table) if now["changes"] else winners
        entry |= {"changes": run, "changed_rows": _write(spark, table, changed, run, not now["changes"])}
    elif won:
        over = lay_over(layers[0], winners, table) if now["changes"] else winners
        whole = lay_over(layers[-1], over, table) if now["base"] else over
        _write(spark, table, whole, run, not now["base"])
        entry |= {"base": run, "base_version": now["version"] + 1, "changes": None, "changed_rows": 0}
    counts["kept"] = now["rows"] - sum(counts[name] for name in ("updated", "unchanged", "stale"))
    return _entered(spark, table, entry, "upsert", batch_id, run_ts, counts, work)


def rebuild(
    spark: SparkSession, table: StateTable, source: DataFrame, batch_id: str, run_ts: Column
) -> DataFrame:
    """Make the table the newest rows of ``source`` alone, and return the audit row. A row that
    is as new as the one held keeps the version that it is from."""
    now, run = _present(spark, table, any_buckets=True), uuid.uuid4().hex
    work = f"{table.path}/work/run={run}"
    batch = _newest(spark, table, source, f"{work}/batch")
    held = table.rows(spark).select(table.key, _side(table.order).alias(HELD), F.col(VERSION).alias("_from"))
    same = F.col(HELD).eqNullSafe(_side(table.order))
    version = F.when(same, F.col("_from")).otherwise(F.lit(now["version"] + 1).cast("bigint"))
    versioned = batch.join(held, table.key, "left").withColumn(VERSION, version)
    versioned = versioned.select(*table.stored_schema.names)
    return _anew(spark, table, now, versioned, run, "rebuild", "inserted", batch_id, run_ts, work)


def rebucket(spark: SparkSession, table: StateTable, batch_id: str, run_ts: Column) -> DataFrame:
    """Write the table anew in ``table.buckets`` buckets, whatever number it had."""
    now, run = _present(spark, table, any_buckets=True), uuid.uuid4().hex
    rows = table.rows(spark)
    return _anew(spark, table, now, rows, run, "rebucket", "kept", batch_id, run_ts, None)


def purge(
    spark: SparkSession, table: StateTable, gone: str, horizon: datetime, batch_id: str, run_ts: Column
) -> DataFrame:
    """Forget rows for which ``gone`` (SQL) holds and that are older than ``horizon``, in the
    first order column; return the audit row.

    From then on the table takes in no event older than the horizon: it could revive what is
    forgotten. A horizon never goes back, other than by a ``rebuild`` from all events.
    """
    now, run = _present(spark, table, any_buckets=True), uuid.uuid4().hex
    until = max(filter(None, (now["horizon"], horizon.isoformat(" "))))
    forgotten = F.coalesce(F.expr(gone), F.lit(False)) & _older(table, until)
    rows = table.rows(spark).where(~forgotten)
    now = {**now, "horizon": until}
    return _anew(spark, table, now, rows, run, "purge", "kept", batch_id, run_ts, None)


def late_events(spark: SparkSession, table: StateTable) -> DataFrame:
    """The events that batches could not take in because they came after a purge beyond their
    time, with the reason."""
    entries = (journal.entry(spark, table.journal, v) for v in journal.numbers(spark, table.journal))
    runs = [entry["late"] for entry in entries if entry["late"]]
    schema = T.StructType(table.schema.fields + [T.StructField("reason", T.StringType())])
    if not runs:
        return spark.createDataFrame([], schema)
    # A batch brought in again leaves them again.
    return spark.read.schema(schema).parquet(*map(table.late_folder, runs)).distinct()


def _older(table: StateTable, horizon: str) -> Column:
    # An event without a time is older than any.
    kind = table.schema[table.order[0]].dataType
    return F.coalesce(F.col(table.order[0]) < F.lit(horizon).cast(kind), F.lit(True))


def _keep_late(events: DataFrame, path: str, run: str) -> str | None:
    events.withColumn("reason", F.lit(TOO_LATE)).write.parquet(path)
    return None if events.sparkSession.read.parquet(path).isEmpty() else run


def _anew(spark, table, now, rows, run, operation, action, batch_id, run_ts, work) -> DataFrame:
    many = _write(spark, table, rows, run, True)
    entry = EMPTY | {"base": run, "base_version": now["version"] + 1, "rows": many, "version": now["version"]}
    if operation != "rebuild":
        entry["horizon"] = now["horizon"]
    counts = dict.fromkeys(ACTIONS, 0) | {action: many}
    return _entered(spark, table, entry, operation, batch_id, run_ts, counts, work)


def last_operation(spark: SparkSession, table: StateTable) -> DataFrame:
    """Version, time, operation and counts of the latest finished batch, as one row."""
    found = journal.numbers(spark, table.journal)
    if not found:
        return spark.createDataFrame([], OPERATION)
    return journal.one(spark, table.journal, found[-1], OPERATION)


def operations(spark: SparkSession, table: StateTable) -> DataFrame:
    """The same for all finished batches."""
    return journal.history(spark, table.journal, OPERATION)


def vacuum(spark: SparkSession, table: StateTable, fed_to: int = 0) -> None:
    """Delete the folders of runs that the newest version does not name, and the feed up to
    version ``fed_to``. Not to be run while the table is being written, or an older version
    still being read."""
    now = journal.newest(spark, table.journal) or EMPTY
    for name in files.matching(spark, f"{table.path}/data/run=*"):
        run = name.partition("=")[2]
        if run not in (now["base"], now["changes"]):
            spark.sql(f"DROP TABLE IF EXISTS {_name(run)}")
            files.delete(spark, table.folder(run))
    for number in journal.numbers(spark, table.journal):
        if number <= fed_to and (run := journal.entry(spark, table.journal, number)["feed"]):
            files.delete(spark, table.feed_folder(run))


def _present(spark: SparkSession, table: StateTable, any_buckets: bool = False) -> dict:
    now = journal.newest(spark, table.journal) or {**EMPTY, "buckets": table.buckets}
    if now["buckets"] != table.buckets and not any_buckets:
        raise ValueError(f"the table was not written with {table.buckets} buckets; see rebucket")
    return now


def _newest(spark: SparkSession, table: StateTable, source: DataFrame, path: str) -> DataFrame:
    newest = latest_per_key(source.select(*table.schema.names), table.key, table.order)
    key = F.col(table.key)
    checked = F.when(key.isNotNull(), key).otherwise(F.raise_error(F.lit("event without a key")))
    newest.withColumn(table.key, checked).write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def _counts(judged: DataFrame) -> dict[str, int]:
    # Counted on finished files: counters inside the writing job would count a task
    # twice when a lost executor makes it run again.
    actions = [F.count_if(F.col(ACTION) == name).alias(name) for name in ACTIONS]
    return judged.agg(*actions, F.count_if(F.col(WINS)).alias("won")).first().asDict()


def _write(spark: SparkSession, table: StateTable, rows: DataFrame, run: str, spread: bool) -> int:
    """Write a layer, one file per bucket, and return its number of rows. Rows that come out of a
    join of layers are clustered already; others are to be spread."""
    if spread:
        rows = rows.repartition(table.buckets, table.key)
    writer = rows.write.format("parquet").bucketBy(table.buckets, table.key).sortBy(table.key)
    writer.option("path", table.folder(run)).saveAsTable(_name(run))
    return spark.table(_name(run)).count()


def _entered(spark, table, layers, operation, batch_id, run_ts, counts, work) -> DataFrame:
    version = layers["version"] + 1
    named = {name: layers[name] for name in EMPTY if name != "version"}
    named |= {"feed": layers.get("feed"), "won": layers.get("won", layers["rows"]), "late": layers.get("late")}
    entry = {
        **named,
        "batch_id": batch_id,
        "run_ts": spark.range(1).select(run_ts.cast("timestamp_ntz").cast("string")).first()[0],
        "operation": operation,
        "buckets": table.buckets,
        **counts,
    }
    journal.add(spark, table.journal, version, entry)
    if work:
        files.delete(spark, work)
    return journal.one(spark, table.journal, version, OPERATION)
