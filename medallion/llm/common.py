"""Tables, scratch tables and batches shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from medallion.session import work_folder

# White space of the word rule [^\x20\x09-\x0D]+, as a Java character class.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: later steps read it however often, and a
    lost executor costs its tasks only."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """The name, or with more underscores one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that tasks hold: their rows alone would not bound long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` text bytes, or of one longer text."""
    lengths = pc.binary_length(texts).fill_null(0).to_numpy()
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``limit`` bytes of text, which span batches or parts of one."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for start, end in slices(batch.column(column), limit):
            part = batch.slice(start, end - start)
            held.append(part)
            size += pc.sum(pc.binary_length(part.column(column))).as_py() or 0
            if size >= limit:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def arrow_table(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
