"""Vector codes against brute force."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from strandframe.llm import common, vectorcodes


def brute(rows, parts=8, entries=16, rounds=6):
    fit = [r for r in rows if r[1] and len(r[1]) % parts == 0 and all(x is not None and math.isfinite(x) for x in r[1])]
    fit.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    fit = [r for r in fit if len(r[1]) == len(fit[0][1])]
    if not fit:
        return []
    width = len(fit[0][1]) // parts
    x = [[[math.floor(4096 * v) for v in r[1][p * width : (p + 1) * width]] for p in range(parts)] for r in fit]
    books = [[x[i][p] for i in range(min(entries, len(fit)))] for p in range(parts)]

    def near(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups: dict[int, list] = {}
            for v in x:
                groups.setdefault(near(v[p], books[p])[1], []).append(v[p])
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(books[p])]
    last = [[near(v[p], books[p]) for p in range(parts)] for v in x]
    errors = [sum(d for d, _ in row) for row in last]
    by_label: dict = {}
    for r, e in zip(fit, errors, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in row), e, by_label[r[2]], digest) for r, row, e in zip(fit, last, errors, strict=True)), key=str)


def got(df, **how):
    return sorted(map(tuple, vectorcodes.digests(df, **how).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 24))
    out = [(i, np.float32(centres[i % 5] + 0.2 * rng.normal(size=24)).tolist(), int(i % 3)) for i in range(100, 500)]
    out += [(i, np.float32(centres[0]).tolist(), None) for i in range(500, 700)]  # one vector in many copies
    out += [(i, np.float32(np.round(rng.normal(size=24) * 4) / 4096).tolist(), 7) for i in range(700, 800)]  # ties
    return out + [(1, None, 1), (2, [0.5] * 23 + [float("nan")], 1), (3, [0.5] * 23 + [None], 1), (4, [float("inf")] * 24, 2), (99, [0.25] * 24, 2), (99, [0.25] * 24, 2), (None, [-0.75] * 24, 1), (5, [1.0] * 25, 1), (800, [1.0] * 16, 1), (801, [], 1)]


def test_equals_brute_force(spark, rows, monkeypatch):
    assert got(frame(spark, rows)) == brute(rows)
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    few = rows[:60]
    assert got(frame(spark, few), entries=5, rounds=2) == brute(few, entries=5, rounds=2)


def test_few_and_no_vectors(spark, rows):
    three = [(9, [0.1 * i for i in range(8)], 1), (8, [-0.1] * 8, 1), (7, [0.0] * 8, None)]
    assert got(frame(spark, three)) == brute([(i, np.float32(v).tolist(), c) for i, v, c in three])
    assert got(frame(spark, rows).limit(0)) == [] and got(frame(spark, rows[-10:-6])) == []


def test_trees_cover_their_points():
    rng = np.random.default_rng(1)
    for points in (rng.integers(-3000, 3000, (700, 8)), np.zeros((300, 3), np.int64), rng.integers(0, 2, (500, 2))):
        tree = vectorcodes.cover_tree(points)
        placed, nodes = points[tree["order"]], tree["nodes"]
        assert sorted(tree["order"]) == list(range(len(points)))
        for (begin, end, center, child, children), radius in zip(nodes, tree["radius"], strict=True):
            distances = np.sqrt(((placed[begin:end] - placed[center]) ** 2).sum(1))
            assert begin <= center < end and distances.max() <= radius + 1e-9
            if children:
                own = nodes[child : child + children]
                assert own[0, 0] == begin and own[-1, 1] == end and (own[1:, 0] == own[:-1, 1]).all() and (placed[own[0, 2]] == placed[center]).all()
                apart = placed[own[:, 2]]
                gaps = np.sqrt(((apart[:, None] - apart[None]) ** 2).sum(2)) + np.eye(children) * 1e9
                assert gaps.min() > radius / 2 - 1e-9
        assert (vectorcodes.node_sums(placed, nodes)[0] == points.sum(0)).all()
        entries = points[:9]
        seen = np.full(len(points), -1)
        whole = 0
        for of, best, single in vectorcodes.descend(placed, nodes, tree["radius"], entries):
            for k, e in zip(of, best, strict=True):
                seen[slice(k, k + 1) if len(single) else slice(*nodes[k, :2])] = e
            whole += 0 if len(single) else int((nodes[of, 1] - nodes[of, 0]).sum())
        assert (seen == vectorcodes.nearest(placed, entries)[0]).all() and whole


def test_codes_stand_for_their_entries(spark, rows):
    coded, books = vectorcodes.train(frame(spark, rows))
    x = {r[0]: [math.floor(4096 * v) for v in r[1]] for r in rows if 100 <= (r[0] or 0) < 800}
    for r in vectorcodes.reconstructed(coded.filter("vec_id >= 100"), books).collect():
        assert sum((a - b) ** 2 for a, b in zip(r["ints"], x[r["vec_id"]], strict=True)) == r["error"]
    with pytest.raises(ValueError):
        vectorcodes.train(frame(spark, rows), entries=300)


def test_table_equals_sql(spark):
    path = "/root/testdata/sf0.01/embeddings.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    want = con.execute(f"SELECT vec_id, code, error, label_error, codebooks_sha256 FROM ({vectorcodes.oracle_sql()})").fetchall()
    assert got(spark.read.parquet(path)) == sorted(want, key=str)
