"""A training-corpus pipeline over ``documents``: five stages, each one operator of ``quirestone.llm``.

1. language: documents without a recognisable language go (no letters, or no language with at least half the posterior); all others stay.
2. near_duplicates: one document of each near-duplicate group stays, the one with the smallest id.
3. secrets: all documents stay; secrets in their texts are replaced by a mark.
4. mixture: sources are drawn to their target weights; whole documents, one drawn twice is there twice, in a shuffled order.
5. packing: what is left becomes token sequences; one row for each piece.

All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quirestone.llm import language_id, minhash, mixing, packing, secret_scan
from quirestone.llm.common import settled


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated_documents(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixture", mixture), ("packing", sequences)]

#: Signatures, models and tokenizers can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; every stage reads what the one before wrote, which goes after it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
