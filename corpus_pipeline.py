"""Documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; its result is written as Parquet and read again for the next one. All but
the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.near_dups import keep_one_of_each
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality_rules import keep_good
from tidemark.llm.secret_scan import redact_secrets
from tidemark.shared import staged

#: Percent of shared word shingles from which documents are near duplicates.
SIMILAR = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return keep_one_of_each(docs, percent=SIMILAR)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; all documents stay."""
    return redact_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's tokens lie in the packed sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("secret_scan", secrets_stage),
    ("packing", packing_stage),
]

#: Regex automata, tokens and best fit are not SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
