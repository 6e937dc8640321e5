"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.llm import ann, bpe, convrepair, fingerprint, langid, licenses, linededup, mixing, neardup, pii, tokenstore, toxicity, vectorcodes
from strandframe.llm.common import small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op6_tokenstore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.roundtrip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_table(spark, sf_dir, "documents"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edits(_table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(_table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convrepair.digests(convrepair.damage(_table(spark, sf_dir, "conversations")))


def op12_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digests(_table(spark, sf_dir, "documents"), min_chars=1, min_docs=10)


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.digests(_table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_bpe": op2_bpe,
    "op3_ann": op3_ann,
    "op4_toxicity": op4_toxicity,
    "op5_neardup": op5_neardup,
    "op6_tokenstore": op6_tokenstore,
    "op7_pii": op7_pii,
    "op8_fingerprint": op8_fingerprint,
    "op9_licenses": op9_licenses,
    "op10_mixing": op10_mixing,
    "op11_repair": op11_repair,
    "op12_linededup": op12_linededup,
    "op13_codes": op13_codes,
}

ORACLE_SQL: dict[str, str] = {
    "op10_mixing": mixing.oracle_sql(),
    "op11_repair": convrepair.oracle_sql(),
    "op12_linededup": linededup.oracle_sql(),
    "op13_codes": vectorcodes.oracle_sql(),
}
