"""From raw documents to token ids: language, near-duplicates, personal data, mixing, encoding.

Each stage gets the documents its predecessor kept; all but the last return the columns of documents. run() writes each
stage's result as Parquet into the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strandframe.llm import bpe, langid, mixing, neardup, pii
from strandframe.llm.common import small_batches, stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; others go."""
    small_batches(spark)
    return langid.recognised(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8), the one with the smallest id."""
    small_batches(spark)
    return neardup.deduplicated(docs, width=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data masked in the texts."""
    small_batches(spark)
    return pii.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: documents left out, or repeated, shuffled within output shards."""
    return mixing.mixed_documents(docs).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every document of the mix."""
    small_batches(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("pii", personal_data),
    ("mixing", source_mix),
    ("bpe", token_ids),
]

#: SQL can't express a learned classifier, so the stages are tested against brute-force versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
