"""Nearest neighbours and mixing."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strandframe.llm import ann, mixing


def check_search(df, rows, k=10):
    """Recall against brute force; ranks, scores and ties of what is found."""
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    got: dict[int, list] = {}
    for r in ann.search(df, F.col("vec_id") % 10 == 0, k).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    hits = total = 0
    for q in ids[ids % 10 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        others = ids != q
        best = sorted(zip(d[others], ids[others], strict=True))[:k]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, min(k, len(ids) - 1) + 1)) and [(s, i) for _, s, i in mine] == sorted((s, i) for _, s, i in mine)
        assert all(abs(s - d[ids == i][0]) < 1e-9 for _, s, i in mine)
        hits += len({i for _, i in best} & {i for _, _, i in mine})
        total += len(best)
    return hits / total


def test_recall_on_clusters_with_copies(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    x = [(centres[i % 12] + 0.3 * rng.normal(size=16)).tolist() for i in range(900)] + [[1.0] * 16] * 300
    rows = [(i, v) for i, v in enumerate(x)]
    assert check_search(spark.createDataFrame([(i, v, "q") for i, v in rows], "vec_id long, embedding array<float>, cls string"), [(i, np.float32(v).tolist()) for i, v in rows]) >= 0.9


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (10, [0.0, 1.0]), (20, [1.0, 0.0]), (3, [-0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [None, 1.0]), (7, [float("nan"), 1.0]), (30, [float("inf"), 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert check_search(df, [(0, [1.0, 0.0]), (10, [0.0, 1.0]), (20, [1.0, 0.0]), (3, [0.0, 1.0])]) == 1.0
    assert ann.search(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0 and ann.search(df.filter("vec_id = 4"), F.col("vec_id") % 2 == 0).count() == 0


def test_repeated_ids_hide_nobody(spark):
    rows = [(100, [1.0, 2.0])] * 12 + [(200, [1.0, 2.0]), (300, [1.0, 2.0]), (400, [5.0, 5.0]), (100, [4.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["vec_id"], round(r["score"], 6)) for r in ann.search(df, F.col("vec_id") == 200, 2).collect())
    assert got == [(200, 100, 0.0), (200, 300, 0.0)]
    got = [(r["vec_id"], r["rank"]) for r in ann.search(df.filter("vec_id <> 200"), F.col("vec_id") == 400, 5).collect()]
    assert got == [(100, 1), (100, 2), (300, 3)]


def test_lists_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    monkeypatch.setattr(ann, "QUERIES", 8)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8)).round(3)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert check_search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), rows) >= 0.95


def brute_mix(rows, weights=(5, 2, 1), share=1.5, most=2):
    size = {}
    for source, n in rows:
        size[source] = size.get(source, 0) + n
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    open_, target, left = set(order), {}, share * sum(size.values())
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if level * weight[s] > most * size[s]}
        if not over:
            return {**target, **{s: level * weight[s] for s in open_}}, size
        for s in over:
            target[s] = most * size[s]
            left -= target[s]
        open_ -= over


def check_mix(docs):
    import re

    rows = mixing.mix(docs).collect()
    sizes = {(r["doc_id"], r["source"]): len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect()}
    target, total = brute_mix([(r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect()])
    of = {i: s for i, s in sizes}
    taken = dict.fromkeys(total, 0)
    assert len(rows) == docs.count()
    for r in rows:
        s = of[r["doc_id"]]
        assert r["size"] == sizes[r["doc_id"], s] and r["source_size"] == total[s] and np.isclose(r["target"], target[s]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in total)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))


def test_mix_matches_brute_force(odd, small_docs):
    check_mix(odd)
    check_mix(small_docs)


def test_mix_of_nothing(spark, empty):
    assert mixing.mix(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.mix(blank).collect()] == [(0.0, 0)] * 2


def test_mix_matches_sql(small_docs):
    c = duckdb.connect()
    c.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    columns = ["doc_id", "size", "source_size", "target", "taken", "shard_words"]
    for how in ({}, {"share": 0.7, "shards": 4, "blocks": 64, "seed": 9}):
        want = c.execute(f"SELECT {', '.join(columns)} FROM ({mixing.oracle_sql(**how)})").fetchall()
        assert sorted(map(tuple, mixing.mix(small_docs, **how).select(*columns).collect())) == sorted(want)


@pytest.mark.parametrize("total,good,drawn", [(40, 15, 20), (3000, 900, 1500), (10, 0, 5), (10, 10, 4), (0, 0, 0)])
def test_hypergeometric_draws(spark, total, good, drawn):
    rows = spark.range(2000).select(mixing._hypergeometric((F.col("id") + 0.5) / 2000, *(F.lit(x).cast("long") for x in (total, good, drawn))).alias("k")).collect()
    k = np.array([r["k"] for r in rows])
    mean = drawn * good / max(1, total)
    var = mean * (1 - good / max(1, total)) * (total - drawn) / max(1, total - 1)
    assert k.min() >= max(0, drawn - total + good) and k.max() <= min(good, drawn)
    assert abs(k.mean() - mean) < 0.1 + 0.01 * mean and abs(k.var() - var) < 0.2 + 0.05 * var


def test_shards_tile_each_source(small_docs):
    drawn = mixing.draws(mixing.sizes(small_docs), shards=8, blocks=256)
    words = np.array([r["shard_words"] for r in drawn.collect()])
    assert words.min() >= 0 and words.sum(0).max() < 1.3 * words.sum(0).mean()


def test_many_sources_in_groups(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 8)
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), None if i % 40 == 39 else f"s{i % 40:02}") for i in range(400)], "doc_id long, text string, source string")
    check_mix(docs)
    cuts = mixing.shard_cuts(mixing.targets(mixing.sizes(docs)), shards=8, blocks=2000).collect()
    total = np.zeros(8, np.int64)
    for r in cuts:
        assert r["cuts"][0] == 0 and r["cuts"][-1] == r["draw"] and sorted(r["cuts"]) == r["cuts"]
        total += np.diff(r["cuts"])
    assert len(cuts) == 40 and total.max() < 1.15 * total.min()  # shards of equal numbers of blocks


def test_clashing_columns_are_kept(spark):
    docs = spark.createDataFrame([(i, "a b c", "s", "mine", i) for i in range(40)], "doc_id long, text string, source string, shard string, m_order long")
    out = mixing.mixed_documents(docs)
    assert out.columns == [*docs.columns, "shard_"] and {r["shard"] for r in out.collect()} == {"mine"}


def test_mixed_documents(small_docs, odd):
    out = mixing.mixed_documents(small_docs).select(*small_docs.columns)
    taken = {r["doc_id"]: (r["size"], r["taken"]) for r in mixing.mix(small_docs).collect()}
    copies: dict[int, int] = {}
    for r in out.collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    off = [i for i, (n, t) in taken.items() if n and abs(copies.get(i, 0) - t / n) > 0.5 + 1e-9]
    assert not off and max(copies.values()) <= 2
    assert mixing.mixed_documents(odd).select(*odd.columns).count() > 0


def test_rows_that_share_an_id_get_their_own_copies(spark):
    # Each row has a size of its own, so that its copies are known by it.
    rows = [(i, " ".join(["w"] * n)) for n, i in enumerate([None] * 60 + [7] * 40 + list(range(100, 140)), 10)]
    docs = spark.createDataFrame([(i, t, "ab"[len(t) % 4 // 2]) for i, t in rows], "doc_id long, text string, source string").repartition(3)
    for share in (0.4, 1.5):
        drawn = mixing.mix(docs, share=share).collect()
        copies: dict[int, int] = {}
        for r in mixing.mixed_documents(docs, share=share).collect():
            copies[len(r["text"].split())] = copies.get(len(r["text"].split()), 0) + 1
        off = [r for r in drawn if abs(copies.get(r["size"], 0) - r["taken"] / r["size"]) > 0.5 + 1e-9]
        assert len(drawn) == len(rows) and not off


def test_copies_are_not_collected_by_id(spark, small_docs):
    plan = mixing.mixed_documents(small_docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
