"""A journal of numbered entries beside a table, one small JSON file for each.

An entry is made by creating its file, which fails if the number is taken: two writers that
both want to be next cannot both be. Readers follow the newest entry.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from medallion.sources import files


class ConcurrentWrite(RuntimeError):
    """Another writer has made the entry that this one wanted to make."""


def _file(folder: str, number: int) -> str:
    return f"{folder}/{number:012d}.json"


def numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name.partition(".")[0]) for name in files.matching(spark, f"{folder}/*.json"))


def newest(spark: SparkSession, folder: str) -> dict | None:
    """The last entry, with its ``version``."""
    found = numbers(spark, folder)
    return entry(spark, folder, found[-1]) if found else None


def entry(spark: SparkSession, folder: str, number: int) -> dict:
    return json.loads(files.read_text(spark, _file(folder, number)))


def add(spark: SparkSession, folder: str, version: int, entry: dict) -> None:
    """Make the entry of that number, or raise ``ConcurrentWrite`` if there is one."""
    text = json.dumps({"version": version, **entry}, sort_keys=True)
    if not files.create_text(spark, _file(folder, version), text):
        raise ConcurrentWrite(f"version {version} in {folder} was written by somebody else")


def one(spark: SparkSession, folder: str, number: int, schema: T.StructType) -> DataFrame:
    """That entry as a row of ``schema``; no other is read."""
    return spark.read.schema(schema).json(_file(folder, number))


def history(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All entries as rows of ``schema``, oldest first."""
    if not numbers(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{folder}/*.json").orderBy("version")
