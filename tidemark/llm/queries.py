"""Queries of the training-data operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_tokens, conversation_repair, fingerprints, hard_negatives, html_text, lattice_lm, near_dups, packing, quality_rules, rank_queue, secret_scan, token_files, url_filters


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    judged = url_filters.filter_urls(pages, url_filters.rule_table(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
WITH rules(verdict, host, path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
           ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
),
parts AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
),
found AS (
    SELECT p.host, p.path,
        arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
        arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM (SELECT DISTINCT host, path FROM parts) p
    JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY p.host, p.path
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN found f ON p.host = f.host AND p.path = f.path
"""


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return token_files.token_digests(documents, public_tokenizers.path("word_bpe_49k.json"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    rated = quality_rules.rate_quality(documents)
    return rated.select(*[c for c in rated.columns if c not in ("text", "lang")])


def op4_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dups.near_duplicates(_table(spark, folder, "documents").select("doc_id", "text"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack_documents(documents, public_tokenizers.path("word_bpe_49k.json"))


def op6_bpe_encoding(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return byte_tokens.token_digests(documents, public_tokenizers.path("byte_bpe_50k.json")).drop("text")


def op7_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_table(spark, folder, "documents").select("doc_id", "text"))


def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages).drop("html")


def op9_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return secret_scan.scan_secrets(documents).drop("text")


def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return lattice_lm.score_documents(documents, public_tokenizers.path("piece_bpe_32k.model"))


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return rank_queue.token_digests(documents, ranks, public_tokenizers.PATTERN).drop("text")


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    found = conversation_repair.repair_conversations(conversation_repair.damage_turns(conversations))
    named = found.withColumnRenamed("conv_id", "named")
    every = conversations.select("conv_id").distinct()
    faults = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(named, F.col("conv_id").eqNullSafe(F.col("named")), "left").select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in faults],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, folder, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.mine_hard_negatives(rows, F.col("vec_id") % 50 == 0)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filters": op1_url_filters,
        "op2_token_files": op2_token_files,
        "op3_quality_rules": op3_quality_rules,
        "op4_minhash_near_dedup": op4_minhash_near_dedup,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_bpe_encoding": op6_bpe_encoding,
        "op7_document_fingerprints": op7_document_fingerprints,
        "op8_html_extraction": op8_html_extraction,
        "op9_secret_scans": op9_secret_scans,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_byte_bpe": op11_byte_bpe,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_hard_negatives": op13_hard_negatives,
    }


def llm_oracles() -> dict[str, str]:
    return {"op1_url_filters": OP1_SQL}
