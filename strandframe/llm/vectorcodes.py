"""Vector code compression: Lloyd's rounds on cover trees.

Vectors become integers, floor(4096 * x), and are cut into equal parts; each part position has a codebook. A vector's code
is the number of the nearest entry of each part.

1. Each task takes its rows in blocks of up to ``BLOCK`` and builds a cover tree of each part position: a node's points lie
   within its radius of its centre, children's centres are more than half of that apart, and the first child has the
   parent's centre. Points are stored in the order of the tree, so that a node's points are a range, with the sum of the
   range in the node. The trees are written once, to the shared folder.
2. In a round a task goes down its trees from the root. By the triangle inequality all points of a node go to the entry
   next to its centre, if no other entry is nearer by less than twice the radius: then its sum and count are added as they
   are. Only ambiguous nodes are opened, and only points of ambiguous leaves are compared one by one. Comparisons are of
   exact integers, and the inequality has to hold by more than the error of its square roots.
3. Sums by (part, entry) are added up by Spark; the driver gets the entries only.

So one vector in any number of copies is one node of radius 0, assigned at once.

Defined results: vectors that are null or hold null or non-finite components are left out, as are those whose length is not
that of the vector with the smallest id (of those whose length is a multiple of the parts, and not 0); integers beyond
2**30 / sqrt(width of a part), at which squared distances would not fit, count as that; null ids come last, equal ids by
their vectors; with fewer vectors than entries there are as many entries as vectors; repeated rows are vectors of their
own; null labels are one label; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strandframe.llm.common import attach, give_back, stage

#: Vectors of a block, and points of a leaf, at most.
BLOCK, LEAF = 2048, 24
#: Blocks that go to Python at once.
BATCH = 8


def cover_tree(points: np.ndarray) -> dict[str, np.ndarray]:
    """The tree of integer points (n, w): order (the points' numbers as they stand in the tree) and, of each node, begin and
    end of its range, center (a place in the order), radius, child (number of its first child) and children.

    A node's children follow each other; parents come before children.
    """
    n = len(points)
    order = np.arange(n)
    zero = ((points - points[0]) ** 2).sum(1)
    nodes = [[0, n, 0, float(zero.max()), 0, 0]]
    distance = zero.copy()  # of each place in the order, to the centre of the node that it's in
    at = 0
    while at < len(nodes):
        begin, end, _, far, _, _ = nodes[at]
        if end - begin > LEAF and far > 0:
            own, from_center = order[begin:end].copy(), distance[begin:end].copy()
            cover, groups = far / 4, []
            here = from_center <= cover
            groups.append((own[here], from_center[here]))
            rest, left = own[~here], from_center[~here]
            while len(rest):
                first = int(left.argmax())
                to = ((points[rest] - points[rest[first]]) ** 2).sum(1)
                here = to <= cover
                here[first] = True
                lead = np.flatnonzero(here)
                lead = np.concatenate([[first], lead[lead != first]])
                groups.append((rest[lead], to[lead]))
                rest, left = rest[~here], left[~here]
            nodes[at][4:] = [len(nodes), len(groups)]
            # The centre is a place: a child's first point (the parent's centre comes first in its own group).
            place = begin
            for k, (members, to) in enumerate(groups):
                if k == 0:
                    middle = int(to.argmin())
                    swap = np.concatenate([[middle], np.delete(np.arange(len(members)), middle)])
                    members, to = members[swap], to[swap]
                order[place : place + len(members)], distance[place : place + len(members)] = members, to
                nodes.append([place, place + len(members), place, float(to.max()), 0, 0])
                place += len(members)
            nodes[at][2] = begin
        at += 1
    out = np.array([[*n[:3], *n[4:]] for n in nodes], np.int32).reshape(-1, 5)
    return {"order": order.astype(np.int32), "nodes": out, "radius": np.sqrt(np.array([n[3] for n in nodes]))}


def node_sums(points: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The sum of each node's points, which stand in the order of the tree, from their cumulative sums."""
    before = np.zeros((len(points) + 1, points.shape[1]), np.int64)
    np.cumsum(points, axis=0, out=before[1:])
    return before[nodes[:, 1]] - before[nodes[:, 0]]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each point, of equals the first, and all squared distances."""
    d = ((points[:, None, :] - entries[None]) ** 2).sum(2)
    return d.argmin(1), d


def descend(points: np.ndarray, nodes: np.ndarray, radius: np.ndarray, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(nodes assigned whole, their entries, empty) and (places of single points, their entries, all True), by level."""
    front = np.zeros(1, np.int64)
    while len(front):
        best, d = nearest(points[nodes[front, 2]], entries)
        root = np.sqrt(d.astype(float))
        own = root[np.arange(len(front)), best]
        root[np.arange(len(front)), best] = np.inf
        other = root.min(1)
        sure = (radius[front] == 0) | (own + 2 * radius[front] * (1 + 1e-9) < other * (1 - 1e-9) - 1e-6)
        yield front[sure], best[sure], np.zeros(0, bool)
        open_ = front[~sure]
        leaf = nodes[open_, 4] == 0
        if leaf.any():
            places = np.concatenate([np.arange(a, b) for a, b in nodes[open_[leaf], :2]])
            yield places, nearest(points[places], entries)[0], np.ones(len(places), bool)
        inner = open_[~leaf]
        front = np.concatenate([np.arange(a, a + k) for a, k in nodes[inner, 3:]]) if len(inner) else np.zeros(0, np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], parts: int, width: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        x = table.column("ints").combine_chunks().flatten().to_numpy().astype(np.int64).reshape(table.num_rows, parts, width)
        row = {"ids": table.column("vec_id").to_pylist(), "labels": table.column("label").to_pylist(), "orders": [], "points": [], "nodes": [], "radii": [], "sums": []}
        for p in range(parts):
            own = np.ascontiguousarray(x[:, p])
            tree = cover_tree(own)
            placed = own[tree["order"]]
            row["orders"].append(tree["order"].tobytes())
            row["points"].append(placed.astype(np.int32).tobytes())
            row["nodes"].append(tree["nodes"].tobytes())
            row["radii"].append(tree["radius"].tobytes())
            row["sums"].append(node_sums(placed, tree["nodes"]).tobytes())
        return pa.RecordBatch.from_pylist([row], schema)

    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            piece = batch.slice(0, BLOCK - n)
            batch = batch.slice(len(piece))
            held.append(piece)
            n += len(piece)
            if n == BLOCK:
                yield block(held)
                held, n = [], 0
    if n:
        yield block(held)
    give_back()


def _trees(row: dict, p: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (
        np.frombuffer(row["orders"][p], np.int32), np.frombuffer(row["points"][p], np.int32).reshape(-1, width).astype(np.int64), np.frombuffer(row["nodes"][p], np.int32).reshape(-1, 5),
        np.frombuffer(row["radii"][p], float), np.frombuffer(row["sums"][p], np.int64).reshape(-1, width),
    )


def _summed(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's sums and counts by (part, entry)."""
    parts, k, width = books.shape
    sums, counts = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
    for batch in batches:
        for row in batch.to_pylist():
            for p in range(parts):
                _, points, nodes, radius, node_sum = _trees(row, p, width)
                for of, best, single in descend(points, nodes, radius, books[p]):
                    np.add.at(sums[p], best, points[of] if len(single) else node_sum[of])
                    np.add.at(counts[p], best, 1 if len(single) else nodes[of, 1] - nodes[of, 0])
    rows = [{"part": p, "entry": e, "n": int(counts[p, e]), "sums": sums[p, e].tolist()} for p in range(parts) for e in range(k) if counts[p, e]]
    yield pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))


def _coded(batches: Iterator[pa.RecordBatch], books: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    parts, _, width = books.shape
    for batch in batches:
        for row in batch.to_pylist():
            n = len(row["ids"])
            codes, error = np.zeros((n, parts), np.uint8), np.zeros(n, np.int64)
            for p in range(parts):
                order, points, nodes, radius, _ = _trees(row, p, width)
                own = np.zeros(n, np.int64)
                for of, best, single in descend(points, nodes, radius, books[p]):
                    if len(single):
                        own[of] = best
                    else:
                        for (a, b), e in zip(nodes[of, :2], best, strict=True):
                            own[a:b] = e
                codes[order, p] = own
                error[order] += ((points - books[p][own]) ** 2).sum(1)
            yield pa.RecordBatch.from_pydict({"vec_id": row["ids"], "label": row["labels"], "code": [c.tobytes().hex() for c in codes], "error": error.tolist()}, schema)


def train(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every vector (vec_id, embedding, label), staged, and the codebooks (parts, entries,
    width); entries: 256 at most. None of the codebooks if there are no vectors."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte for each part")
    spark = vectors.sparkSession
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & (F.size("embedding") % parts == 0) & ~bad)
    first = fit.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(1).collect()
    label = vectors.schema["label"].dataType
    out = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not first:
        return spark.createDataFrame([], out), np.zeros((parts, 0, 0), np.int64)
    size = len(first[0][0])
    width = size // parts
    most = math.isqrt((1 << 60) // width)
    whole = F.transform("embedding", lambda x: F.floor(F.greatest(F.lit(float(-most)), F.least(F.lit(float(most)), x * float(scale)))).cast("int"))
    fit = fit.filter(F.size("embedding") == size)
    start = [r[0] for r in fit.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select(whole.alias("ints")).collect()]
    books = np.array(start, np.int64).reshape(len(start), parts, width).transpose(1, 0, 2).copy()
    blocks = T.StructType([T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(label)), *[T.StructField(c, T.ArrayType(T.BinaryType())) for c in ("orders", "points", "nodes", "radii", "sums")]])
    ints = fit.select(F.col("vec_id").cast("long").alias("vec_id"), "label", whole.alias("ints"))
    trees = stage(ints.mapInArrow(functools.partial(_blocks, parts=parts, width=width, schema=to_arrow_schema(blocks)), blocks), "code-trees", "zstd")
    key, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, str(BATCH))  # a block is large; all that reads blocks ends in here
    try:
        for _ in range(rounds):
            sums = trees.mapInArrow(functools.partial(_summed, books=books), "part int, entry int, n long, sums array<long>")
            each = sums.select("part", "entry", "n", F.posexplode("sums").alias("at", "v"))
            for r in each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(20,0)")).alias("v")).collect():  # an entry's components
                books[r["part"], r["entry"], r["at"]] = int(r["v"]) // r["n"]
        coded = stage(trees.mapInArrow(functools.partial(_coded, books=books, schema=to_arrow_schema(out)), out), "codes")
    finally:
        spark.conf.set(key, before)
    return coded, books


def codebook_digest(books: np.ndarray) -> str:
    """sha256 of all entries' integers by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def reconstructed(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """coded with ints, the integers that its codes stand for."""
    entries = F.array(*[F.array(*[F.lit(e).cast("array<bigint>") for e in part.tolist()]) for part in books])
    each = F.transform(F.sequence(F.lit(0), F.lit(len(books) - 1)), lambda p: F.get(F.get(entries, p), F.conv(F.substr("code", p * 2 + 1, F.lit(2)), 16, 10).cast("int")))
    return coded.withColumn("ints", F.flatten(each))


def digests(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that takes part."""
    coded, books = train(vectors, parts, entries, rounds)
    totals = stage(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(20,0)")).cast("long").alias("label_error"), F.count("*").alias("n")), "code-labels")
    return attach(coded, totals, ["label"], "n").select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))


def oracle_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """DuckDB SQL for digests()'s rows: every part compared with every entry, in each round."""
    nearest_ = "SELECT row, p, arg_min(e, d * 256 + e) AS e, min(d) AS d FROM (SELECT x.row, x.p, c.e, list_sum(list_transform(range(1, len(x.v) + 1), lambda j: (x.v[j] - c.v[j]) * (x.v[j] - c.v[j])))::HUGEINT AS d FROM points x JOIN book{0} c ON x.p = c.p) GROUP BY row, p"
    steps = "".join(
        f""", near{t} AS MATERIALIZED ({nearest_.format(t)}
), mean{t} AS (
  SELECT p, e, list(m ORDER BY j) AS v FROM (SELECT p, e, j, ((s - ((s % n) + n) % n) // n)::BIGINT AS m FROM (SELECT a.p, a.e, j, sum(x.v[j]) AS s, count(*) AS n FROM near{t} a JOIN points x USING (row, p), range(1, (SELECT max(len(v)) FROM points) + 1) r(j) GROUP BY a.p, a.e, j)) GROUP BY p, e
), book{t + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.v, c.v) AS v FROM book{t} c LEFT JOIN mean{t} m ON c.p = m.p AND c.e = m.e
)"""
        for t in range(rounds)
    )
    return f"""
WITH fit AS (
  SELECT row_number() OVER () AS row, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {parts} = 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r FROM fit WHERE len(embedding) = (SELECT len(embedding) FROM fit ORDER BY vec_id NULLS LAST, embedding LIMIT 1)
), points AS MATERIALIZED (
  SELECT row, r, p, list_transform(range(1, len(embedding) // {parts} + 1), lambda j: floor(4096 * embedding[p * (len(embedding) // {parts}) + j]::DOUBLE)::BIGINT) AS v FROM ranked, range(0, {parts}) t(p)
), book0 AS MATERIALIZED (
  SELECT p, r - 1 AS e, v FROM points WHERE r <= {entries}
){steps}, final AS MATERIALIZED ({nearest_.format(rounds)}
), coded AS (
  SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM final GROUP BY row
), digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN ranked USING (row), digest
"""
