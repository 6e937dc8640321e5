"""Joins with hot keys, places of rows."""

import pytest
from pyspark.sql import functions as F

from strandframe.llm import common


@pytest.mark.parametrize("share,limit", [(3, 0), (1, 0), (10_000, 0), (3, 16_000_000)])
def test_attach_whatever_is_hot(spark, tmp_path, monkeypatch, share, limit):
    monkeypatch.setattr(common, "HOT_SHARE", share)
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(common.small, "__defaults__", (None, limit))
    rows = [(i, [1, 1, 1, 2, None, 5, i][i % 7], "x") for i in range(700)]
    counts: dict = {}
    for _, k, _ in rows:
        counts[k] = counts.get(k, 0) + 1
    table = [(k, n, (k or 0) * 10, None) for k, n in counts.items() if k != 5]
    spark.createDataFrame(table, "k long, n long, v long, w long").write.parquet(str(tmp_path / "t"))
    got = common.attach(spark.createDataFrame(rows, "id long, k long, s string"), spark.read.parquet(str(tmp_path / "t")), ["k"], "n")
    assert got.columns == ["id", "k", "s", "n", "v", "w"]
    want = [(i, k, s, None, None, None) if k == 5 else (i, k, s, counts[k], (k or 0) * 10, None) for i, k, s in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_places_tell_all_rows_apart(spark, tmp_path, monkeypatch):
    spark.range(50).withColumn("text", F.lit("same")).repartition(3).write.parquet(str(tmp_path / "a"))
    staged = []
    monkeypatch.setattr(common, "stage", lambda df, *a, real=common.stage, **b: staged.append(1) or real(df, *a, **b))
    docs = spark.read.parquet(str(tmp_path / "a"))

    def places(df):
        return common.placed(df, "t").select(*common.PLACE).distinct().count()

    assert places(docs) == 50 and places(docs.select("text").filter("text = 'same'")) == 50 and not staged
    assert common.placed(docs, "t").exceptAll(common.placed(docs, "t")).count() == 0
    assert places(docs.union(docs)) == 100 and places(docs.join(spark.range(2).select(F.col("id").alias("k")))) == 100 and places(docs.select("*", F.explode(F.array(F.lit(1), F.lit(2))))) == 100
    assert places(spark.read.parquet(str(tmp_path / "a"), str(tmp_path / "a"))) == 100 and places(spark.createDataFrame([(1,)] * 9, "x int")) == 9 and len(staged) == 5
