"""Corpus preparation: from raw documents to token ids.

Each stage calls one corpus operator on everything its predecessor kept; its
result is written as Parquet and read again as the next stage's documents. All
stages but the last return the columns of ``documents``.

1. language_id: documents whose language cannot be told (no letters) go
2. exact_dedup: of equal texts the largest doc_id stays
3. simhash: of each near-duplicate group the smallest doc_id stays
4. source_mix: sources are mixed to target weights; rows taken twice appear twice
5. bpe_encode: token counts and digests per remaining row

Nulls, empty and long texts, ties, repeated rows, empty tables and clashing
extra columns are handled as the operators' docstrings state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.llm import bpe_pieces, exact_dedup, language_id, mixing, simhash
from candlewick.session import cut_lineage


def stage_language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def stage_exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def stage_source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample_mix(docs)


def stage_bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_pieces.encode_documents(docs, ids=False)


STAGES = [
    ("language_id", stage_language_id),
    ("exact_dedup", stage_exact_dedup),
    ("simhash", stage_simhash),
    ("source_mix", stage_source_mix),
    ("bpe_encode", stage_bpe_encode),
]

#: SQL expresses neither the fingerprint stage nor the encoding; the pipeline
#: is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
