"""Approximate nearest neighbours: an inverted file of coarse centroids with product-quantised residuals, asymmetric
distance tables, and exact reranking.

1. Equal vectors are one class, which keeps its smallest ids (``k`` + 1 different ones: no answer needs more); so
   thousands of copies don't crowd a list or a ranking, and ties go to the smaller ids.
2. On a bounded sample of classes (``SAMPLE``, first by a hash) the driver fits coarse centroids (about half the root
   of the number of classes, ``LISTS`` at most) and, on the residuals, a codebook of 256 centroids for each subspace.
   On the sample it also measures, against brute force, how many lists must be probed and how many candidates reranked
   for a recall of ``RECALL``: the data decide, as random directions need nearly all lists and clustered ones few. Codes
   are fine (a byte for each of up to ``MOST_SUBSPACES`` subspaces), so that ``RERANK`` candidates, or a few times the
   sample's rank, do at any size of the table.
3. Every class is assigned to its list and encoded; a list's codes are packed in blocks of about ``BLOCK`` rows, a
   list of any length being several blocks, with no cap.
4. Queries are packed in blocks for each list they probe, which go to each block of the list: (list, block) is what
   they meet on, so a popular list is as many keys as it has blocks. Tasks are as many as these meetings ask for (by
   size alone the codes would all be one task's). A task computes each query's distance table to the list's residuals
   and adds up the table's entries under the codes. Pairs of a query and a vector are never rows: a batch of blocks
   gives each query's best candidates only.
5. The best candidates of each query are ranked by the exact Euclidean distance in double precision on the original
   vectors.

Defined results: vectors that are null, zero, hold a null or non-finite component, or have another length than the
commonest, and rows with a null id, take no part, neither as queries nor as candidates; if an id repeats with different
vectors, its rows are candidates (and queries) of their own, and none of them for a query with that id; rows equal in id
and vector count once; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandframe.llm.common import small, stage

SAMPLE, LISTS, BLOCK, QUERIES, RECALL = 8192, 1024, 2048, 256, 0.97
MOST_SUBSPACES, RERANK = 64, 128
#: Meetings of a block of codes and a block of queries in a task, about.
MEETINGS = 16


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    norms = (centroids**2).sum(1)
    for i in range(0, len(x), 4096):
        out[i : i + 4096] = (norms - 2 * x[i : i + 4096] @ centroids.T).argmin(1)
    return out


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 1) -> np.ndarray:
    """k centroids (fewer, if there are fewer rows); an empty one is put where a row is farthest from its own."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.permutation(len(x))[: min(k, len(x))]].copy()
    for _ in range(rounds):
        own = _nearest(x, centroids)
        n = np.bincount(own, minlength=len(centroids))
        for d in range(x.shape[1]):
            s = np.bincount(own, x[:, d], len(centroids))
            centroids[n > 0, d] = s[n > 0] / n[n > 0]
        if (n == 0).any():
            far = ((x - centroids[own]) ** 2).sum(1).argsort()[::-1]
            centroids[n == 0] = x[far[: int((n == 0).sum())]]
    return centroids


@dataclass
class Index:
    coarse: np.ndarray  # list x dimension
    books: np.ndarray  # subspace x code x dimension of it
    probes: int
    rerank: int

    def assign(self, x: np.ndarray) -> np.ndarray:
        return _nearest(x, self.coarse)

    def encode(self, x: np.ndarray, lists: np.ndarray) -> np.ndarray:
        r = (x - self.coarse[lists]).reshape(len(x), len(self.books), -1)
        return np.stack([_nearest(r[:, s], book) for s, book in enumerate(self.books)], 1).astype(np.uint8)

    def probed(self, q: np.ndarray, probes: int | None = None) -> np.ndarray:
        d = (self.coarse**2).sum(1) - 2 * q @ self.coarse.T
        return np.argsort(d, 1, kind="stable")[:, : probes or self.probes]

    def distances(self, q: np.ndarray, number: int, codes: np.ndarray) -> np.ndarray:
        """Approximate squared distances of queries to the codes of a list: sums of entries of each query's tables."""
        r = (q - self.coarse[number]).reshape(len(q), len(self.books), 1, -1)
        tables = ((r - self.books[None]) ** 2).sum(3).astype(np.float32)
        total = np.zeros((len(q), len(codes)), np.float32)
        for s in range(len(self.books)):
            total += tables[:, s, codes[:, s]]
        return total


def fit_index(x: np.ndarray, classes: int, k: int, recall: float = RECALL) -> Index:
    """Fit on sampled rows of a table of so many classes."""
    dims = x.shape[1]
    lists = int(np.clip(2 ** round(math.log2(max(1.0, math.sqrt(classes) / 2))), 1, LISTS))
    coarse = kmeans(x, lists)
    own = _nearest(x, coarse)
    subspaces = max(s for s in range(1, min(dims, MOST_SUBSPACES) + 1) if dims % s == 0)
    r = (x - coarse[own]).reshape(len(x), subspaces, -1)
    books = np.stack([kmeans(r[:, s], 256, 8, s) for s in range(subspaces)])
    index = Index(coarse, books, len(coarse), 0)
    # What the sample's own nearest neighbours ask for.
    q = x[np.random.default_rng(2).permutation(len(x))[:128]]
    exact = ((q**2).sum(1)[:, None] + (x**2).sum(1)[None] - 2 * q @ x.T).argsort(1, kind="stable")[:, : k + 1]
    place = index.probed(q, len(coarse)).argsort(1)
    needed = np.sort(np.take_along_axis(place, own[exact], 1).ravel())
    index.probes = int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)))]) + 1
    codes = index.encode(x, own)
    approx = np.empty((len(q), len(x)), np.float32)
    for number in range(len(coarse)):
        at = np.flatnonzero(own == number)
        approx[:, at] = index.distances(q, number, codes[at])
    ranks = np.sort(np.take_along_axis(approx.argsort(1).argsort(1), exact, 1).ravel())
    rank = int(ranks[min(len(ranks) - 1, math.ceil(0.99 * len(ranks)))]) + 1
    index.rerank = max(RERANK, 4 * k, 4 * rank)
    return index


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    flat = column.flatten() if pa.types.is_list(column.type) else column
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, embedding array<double>) of the rows that take part."""
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("embedding"))
    ok = slim.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0))
    commonest = ok.groupBy(F.size("embedding").alias("dims")).count().orderBy(F.desc("count"), "dims").limit(1).collect()
    return ok.filter(F.size("embedding") == (commonest[0]["dims"] if commonest else 0))


def distance(a: Column, b: Column) -> Column:
    """The Euclidean distance of two arrays of doubles."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row for which is_query holds, itself excepted."""
    spark = vectors.sparkSession
    rows = valid(vectors, id_col, vector_col)
    rows = rows.distinct()
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))).filter(F.col("n") <= k + 1)
    classes = stage(first.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("members")).select(F.monotonically_increasing_id().alias("cls"), "members", "embedding"), "ann-classes")
    count = classes.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "embedding")
    asked = stage(asked.join(classes.select("embedding", "cls"), "embedding").select("query_id", "cls"), "ann-queries")
    query_ids = asked.select("cls").distinct()
    queries = stage(classes.join(query_ids, "cls", "left_semi").select(F.col("cls").alias("q"), F.col("embedding").alias("q_vector")), "ann-query-classes")
    n_queries = queries.count()

    sample = _matrix(classes.select("embedding").orderBy(F.xxhash64(F.lit("ann"), "embedding"), "cls").limit(SAMPLE).toArrow().column(0).combine_chunks(), len(classes.first()["embedding"]))
    index = fit_index(sample, count, k)
    dims = sample.shape[1]
    shared = spark.sparkContext.broadcast(index)  # LISTS * dims and 256 * dims numbers at most

    def encode(batches):
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            lists = shared.value.assign(x)
            codes = shared.value.encode(x, lists)
            yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary())], names=["list", "cls", "codes"])

    def probe(batches):
        for batch in batches:
            lists = shared.value.probed(_matrix(batch.column(1), dims))
            at = np.repeat(np.arange(len(lists)), lists.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(lists.ravel().astype(np.int32)), batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))], names=["list", "q", "q_vector"])

    def scan(batches):
        index = shared.value
        for batch in batches:
            found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
            for i in range(batch.num_rows):
                number, ids, codes, qs, q_vectors = (batch.column(c)[i] for c in range(5))
                ids_ = ids.values.to_numpy()
                codes_ = np.frombuffer(b"".join(codes.as_py()), np.uint8).reshape(len(ids_), -1)
                d = index.distances(_matrix(q_vectors.values, dims), number.as_py(), codes_)
                best = np.argpartition(d, index.rerank, 1)[:, : index.rerank] if d.shape[1] > index.rerank else np.tile(np.arange(d.shape[1]), (len(d), 1))
                for q, row, at in zip(qs.as_py(), d, best, strict=True):
                    found.setdefault(q, []).append((row[at], ids_[at]))
            q_out, ids_out, d_out = [], [], []
            for q, parts in found.items():
                d, ids_ = np.concatenate([p for p, _ in parts]), np.concatenate([p for _, p in parts])
                if len(d) > index.rerank:
                    at = np.argpartition(d, index.rerank)[: index.rerank]
                    d, ids_ = d[at], ids_[at]
                q_out.append(np.full(len(d), q, np.int64))
                ids_out.append(ids_)
                d_out.append(d)
            empty = [np.empty(0, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(q_out or empty)), pa.array(np.concatenate(ids_out or empty)), pa.array(np.concatenate(d_out or [np.empty(0, np.float32)]))], names=["q", "cls", "approx"])

    codes = stage(classes.select("cls", "embedding").mapInArrow(encode, "list int, cls long, codes binary"), "ann-codes")
    sizes = codes.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sizes = stage(sizes, "ann-lists")  # a row for each list
    placed = codes.join(small(sizes, len(index.coarse)), "list").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    q_blocks = max(1, -(-n_queries // QUERIES))
    n_blocks = sizes.agg(F.sum("blocks")).first()[0]
    tasks = max(1, math.ceil(n_blocks * q_blocks * index.probes / len(index.coarse) / MEETINGS))
    blocks = placed.groupBy("list", "block").agg(F.collect_list("cls").alias("ids"), F.collect_list("codes").alias("codes"))
    asking = queries.mapInArrow(probe, "list int, q long, q_vector array<double>")
    asking = asking.groupBy("list", F.pmod(F.xxhash64("q"), F.lit(q_blocks)).alias("q_block")).agg(F.collect_list("q").alias("qs"), F.flatten(F.collect_list("q_vector")).alias("q_vectors"))
    to_blocks = asking.join(small(sizes, len(index.coarse)), "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    at = ("list", "block")
    met = blocks.repartition(tasks, *at).join(to_blocks.repartition(tasks, *at), list(at)).select("list", "ids", "codes", "qs", "q_vectors")
    near = met.mapInArrow(scan, "q long, cls long, approx float")
    by_approx = Window.partitionBy("q").orderBy("approx", "cls")
    candidates = stage(near.withColumn("n", F.row_number().over(by_approx)).filter(F.col("n") <= index.rerank).select("q", "cls"), "ann-candidates")
    exact = candidates.join(classes, "cls").join(queries, "q").select("q", "members", distance(F.col("embedding"), F.col("q_vector")).alias("score"))
    by_exact = Window.partitionBy("q").orderBy("score", F.col("members")[0])
    best = exact.withColumn("n", F.row_number().over(by_exact)).filter(F.col("n") <= k + 1)
    each = F.transform("members", lambda m: F.struct(F.col("score").alias("score"), m.alias("vec_id")))
    answers = best.groupBy("q").agg(F.array_sort(F.flatten(F.collect_list(each))).alias("near"))
    own = asked.join(answers, asked["cls"] == answers["q"]).select("query_id", F.slice(F.filter("near", lambda s: s["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return own.select("query_id", F.posexplode("near").alias("at", "hit")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
