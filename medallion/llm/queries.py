"""The operators as registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from medallion.llm import (
    decontamination,
    embedding_dedup,
    hard_negatives,
    html_extraction,
    language_id,
    line_dedup,
    mixing,
    packing,
    pii_surrogates,
    quality_model,
    resampling,
    simhash,
    token_blocks,
)
from medallion.llm.common import table

TOKENIZER = "word_bpe_49k.json"
# A stand-in: users bring a secret of their own.
SURROGATE_KEY = b"replace this key"


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogates.replace(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontamination.contained(documents, benchmark)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality_model.classify(documents, labels)


def op10_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return token_blocks.tokenized(table(spark, sf_dir, "documents"), path)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resampling.resample(documents, benchmark)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_pii_surrogates,
        op2_language_id,
        op3_simhash_near_dedup,
        op4_embedding_near_dedup,
        op5_html_extraction,
        op6_line_dedup,
        op7_source_mixing,
        op8_benchmark_decontamination,
        op9_quality_classifier,
        op10_token_blocks,
        op11_importance_resampling,
        op12_hard_negatives,
        op13_pattern_packing,
    )
}

ORACLES = {
    "op4_embedding_near_dedup": embedding_dedup.ORACLE,
    "op7_source_mixing": mixing.ORACLE,
    "op8_benchmark_decontamination": decontamination.ORACLE,
    "op11_importance_resampling": resampling.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
