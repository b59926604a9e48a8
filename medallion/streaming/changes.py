"""Change events as a stream: landing files into the state table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medallion.operators.cdc import with_tombstones
from medallion.operators.upsert import StateTable, upsert
from medallion.sources.landing import Landing, bad_lines, good_lines, judged, stream

# Spark's setting for the keeper of a stream's state, and its value for RocksDB.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def apply_change_stream(
    spark: SparkSession,
    landing: Landing,
    table: StateTable,
    checkpoint: str,
    run_ts: Column,
    op: str = "op",
    files_per_batch: int | None = None,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Upsert all files that have come in since the last run, then stop.

    Each micro-batch is one upsert. A batch replayed after a failure, or files that come
    in out of order, lead to the same table; one of stale events alone writes no file of it. A
    batch costs its own size, that of the changed rows, and a look at the table's keys. Lines
    that cannot be taken in go to ``rejects_path``, by default below the checkpoint, in a folder
    per batch.
    """
    rejected = rejects_path or f"{checkpoint}/rejects"

    def upsert_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # Parsed once: both the changes and the rejects are taken from the finished file.
        work = f"{checkpoint}/work"
        batch.write.mode("overwrite").parquet(work)
        lines = session.read.schema(batch.schema).parquet(work)
        bad_lines(lines).write.mode("overwrite").parquet(f"{rejected}/batch={number}")
        changes = with_tombstones(good_lines(lines, landing), op)
        upsert(session, table, changes, f"stream-{number}", run_ts)

    lines = judged(stream(spark, landing, files_per_batch), landing)
    return (
        lines.writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True)
        .start()
    )


def newest_versions(changes: DataFrame, table: StateTable) -> DataFrame:
    """Of a stream of changes, the keys whose newest version came in with the micro-batch.

    The newest version of each key is kept as the stream's state, in update mode; of equal
    versions the first to come in stays. So stale events and repeated ones end here, and a
    micro-batch of them alone is empty. The time of the micro-batch tells new from old: it is
    the same for all its rows and when it is replayed.
    """
    now = F.unix_micros(F.current_timestamp())
    payload = [name for name in table.schema.names if name != table.key]
    rows = changes.select(*table.schema.names, now.alias("_seen"))
    first_seen = F.struct(*table.order, (-F.col("_seen")).alias("_first"))
    newest = F.max_by(F.struct(*payload, "_seen"), first_seen)
    held = rows.groupBy(table.key).agg(newest.alias("_newest"))
    return held.where(F.col("_newest._seen") == now).select(
        *[table.key if name == table.key else F.col(f"_newest.{name}") for name in table.schema.names]
    )


def apply_keyed_stream(
    spark: SparkSession,
    landing: Landing,
    table: StateTable,
    checkpoint: str,
    run_ts: Column,
    op: str = "op",
    files_per_batch: int | None = None,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """The same table by way of keyed state; see ``newest_versions``.

    Only keys whose newest version changed reach the upsert, and a micro-batch without any is no
    version of the table. The state has every key's newest version, in RocksDB, in as many
    parts as there were shuffle partitions at the first start; it pays where many events are
    stale or repeated. Rejected lines are a stream of their own, which is run to its end first.
    """
    lines = judged(stream(spark, landing, files_per_batch), landing)
    rejected = (
        bad_lines(lines)
        .writeStream.format("parquet")
        .option("path", rejects_path or f"{checkpoint}/rejects")
        .option("checkpointLocation", f"{checkpoint}/rejected")
        .trigger(availableNow=True)
        .start()
    )
    rejected.awaitTermination()

    def upsert_batch(batch: DataFrame, number: int) -> None:
        work = f"{checkpoint}/work"
        batch.write.mode("overwrite").parquet(work)
        newest = batch.sparkSession.read.schema(batch.schema).parquet(work)
        if not newest.isEmpty():
            upsert(batch.sparkSession, table, newest, f"stream-{number}", run_ts)

    fresh = newest_versions(with_tombstones(good_lines(lines, landing), op), table)
    kept = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS_DB)
    try:
        # The stream takes a copy of the settings when it starts.
        return (
            fresh.writeStream.outputMode("update")
            .foreachBatch(upsert_batch)
            .option("checkpointLocation", f"{checkpoint}/keyed")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        if kept is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, kept)
