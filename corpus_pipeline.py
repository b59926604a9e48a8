"""A corpus pipeline: documents to token ids.

Each stage works on all that the one before kept, written as Parquet and read again. All but
the last return the columns of documents; the last one's rows are those of the token files.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from medallion.llm import decontamination, language_id, mixing, simhash, token_blocks
from medallion.llm.common import table, written
from medallion.llm.queries import TOKENIZER


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without any letter; fills a missing language with the predicted one."""
    return language_id.with_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each SimHash component."""
    return simhash.one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as its source's target asks for, up to three times."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and returns what is read from them."""
    return token_blocks.tokenized(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("token_blocks", write_tokens),
]

# Suffix automata, XXH64 and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
