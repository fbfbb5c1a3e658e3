"""From raw documents to packed training sequences, one operator per stage.

Each stage takes what its predecessor kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, language_id, packing, pii, simhash
from tillroll.llm.common import on_workers, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; a missing ``lang`` is filled in."""
    on_workers(spark)
    return language_id.reject_undetermined(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: shingles of 4 words, at most 4 bits apart."""
    on_workers(spark)
    return simhash.one_per_group(docs, words=4, distance=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a test item."""
    on_workers(spark)
    return decontaminate.without_copies(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; ``n_chars`` follows the text where it did before."""
    on_workers(spark)
    # The row travels as one value, so that no column of it can clash with the ones added.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    masked = pii.redact(docs.select(row, "text", (F.col("n_chars") == F.length("text")).alias("exact")))
    n_chars = F.when(F.col("exact"), F.length("text").cast("long")).otherwise(F.col("row")["n_chars"])
    new = {"text": F.col("text"), "n_chars": n_chars}
    return masked.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens and their places in sequences."""
    on_workers(spark)
    # Workers of earlier stages live on, so less is remembered here than by packing alone.
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, tokenizer, 4096, end_id=1, places=1 << 18)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("pii", private),
    ("best_fit_packing", packed),
]

# Neither the learned languages nor the tokenizer can be put in SQL; tests check the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
