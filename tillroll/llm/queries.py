"""Registered queries of the training-data operators, and their SQL.

Each query applies one operator to the whole of its table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import (
    decontaminate, embedding_dedup, filter_audit, html_layout, language_id, license_align, lm_score, packing, pii,
    simhash, token_alignment, token_records, toxicity,
)
from tillroll.llm.common import table

BYTE_TOKENIZER, WORD_TOKENIZER, PIECE_MODEL = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract_text(table(spark, sf_dir, "pages"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_align.licenses(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_digest(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = token_records.records_digest(docs, public_tokenizers.path(BYTE_TOKENIZER), end_id=0)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_digest(table(spark, sf_dir, "documents"), words=4, distance=4)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path(WORD_TOKENIZER), 4096, end_id=1)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_MODEL)
    return token_alignment.alignment_digest(table(spark, sf_dir, "documents"), *paths)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_embedding_near_dedup, op2_html_extraction, op3_license_scan, op4_language_id, op5_pii,
        op6_token_records, op7_simhash_near_dedup, op8_benchmark_decontamination, op9_best_fit_packing,
        op10_lm_scoring, op11_cross_tokenizer_alignment, op12_toxicity, op13_filter_interaction_audit,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op5_pii": pii.digest_sql(), "op13_filter_interaction_audit": filter_audit.digest_sql()}
