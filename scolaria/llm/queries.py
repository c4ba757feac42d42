"""The registered queries of this subpackage: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scolaria.llm import (
    decontaminate, exact_dedup, filter_audit, html_text, language_id, license_scan, line_dedup, merkle, packing, quality_rules, simhash, token_store, toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc.doc_id", F.explode("matches").alias("match")).select("doc_id", "match.*")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_shared_lines(table(spark, sf_dir, "documents")).select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return judged.select("doc.doc_id", *counts, F.col("rejected_by").isNull().alias("kept"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc.doc_id", "held_out", "score", "predicted")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit_tampering(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_license_scan": op2_license_scan,
    "op3_decontaminate": op3_decontaminate,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_store": op5_token_store,
    "op6_packing": op6_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_toxicity": op8_toxicity,
    "op9_html_text": op9_html_text,
    "op10_simhash": op10_simhash,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_filter_audit": op12_filter_audit,
    "op13_exact_dedup": op13_exact_dedup,
}
