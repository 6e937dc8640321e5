import public_tokenizers as P
from pyspark.sql import functions as F

import corpus_pipeline
from strandframe.llm import bpe, pii


def test_each_stage_does_its_work(spark, small_docs):
    folder = "/root/testdata/sf0.001"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "pii", "mixing", "bpe"]
    docs = small_docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, function(spark, docs, folder).cache()
        assert docs.columns == small_docs.columns
        if name == "language_id":
            assert docs.count() >= 0.98 * before.count() and docs.exceptAll(before).count() == 0
        if name == "near_dedup":
            assert 0 < docs.count() < before.count() and docs.exceptAll(before).count() == 0
        if name == "pii":
            assert docs.count() == before.count() and all(pii.base_spans(r["text"]) == [] for r in docs.collect())
        if name == "mixing":
            assert docs.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    ids = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert ids.columns == ["doc_id", "ids"] and ids.count() == docs.count()
    back = {r["doc_id"]: bytes(r["bytes"]).decode() for r in bpe.decode(ids, P.path("byte_bpe_multi_50k.tiktoken")).collect()}
    assert back == {r["doc_id"]: r["text"] for r in docs.collect()}


def test_odd_rows_pass_all_stages(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, "")
    assert docs.count() > 0


def test_an_empty_table_passes_all_stages(empty):
    docs = empty.select("doc_id", "text", "lang", "source", "n_chars")
    for name, function in corpus_pipeline.STAGES:
        out = function(docs.sparkSession, docs, "")
        assert out.count() == 0, name
        docs = out if name != "bpe" else docs
