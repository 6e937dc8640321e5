"""Line dedup against brute force."""

import hashlib

import duckdb
import numpy as np
import pytest

from strandframe.llm import linededup

SPACE = " \t\n\x0b\f\r"


def brute(rows, min_chars=1, min_docs=10):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))

    seen: dict[str, set] = {}
    for i, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            seen.setdefault(key(line), set()).add(i)
    gone = {k for k, of in seen.items() if len(of) >= min_docs and len(k) >= min_chars}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=str)


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        lines = [f"own line {i} {k}" for k in range(rng.integers(0, 6))]
        lines += ["  Common LINE\t"] * (i % 3 == 0) * int(rng.integers(1, 3)) + [f"shared {i % 40}"] + ["", "   "] * (i % 5 == 0) + [f"GROUP {i % 23} É"]
        rng.shuffle(lines)
        rows.append((i if i % 50 else None, "\n".join(lines)))
    rows += [(400, None), (401, ""), (402, "\n" * 5000 + "x" * 100_000 + "\ncommon line"), (403, "only\x1cthis"), (7, rows[7][1]), (7, rows[7][1])]
    return rows, spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, n_lines string, lost int").repartition(7)


def test_equals_brute_force(spark, planted, odd, empty):
    rows, df = planted
    assert got(linededup.digests(df)) == brute(rows)
    assert got(linededup.digests(df, 12, 3)) == brute(rows, 12, 3)
    assert got(linededup.digests(odd, 1, 2)) == brute([(r["doc_id"], r["text"]) for r in odd.collect()], 1, 2)
    assert linededup.digests(empty).count() == 0


def test_columns_stay(planted):
    _, df = planted
    out = linededup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "n_lines", "lost", "n_lines_", "n_dropped"] and out.select("n_lines").distinct().count() == 1


def test_first_occurrences_stay(spark, planted):
    rows, df = planted
    texts = [r["text"] for r in linededup.dedup_lines(df, 1, 10, keep="first").orderBy("doc_id").collect()]
    keys = [k for t in texts for k in {x.strip(SPACE).lower() for x in t.split("\n")}]
    assert keys.count("common line") == 1 and sum(t.lower().count("common line") for t in texts) == 1
    first = min(i for i, t in rows if i is not None and t and "Common" in t)
    assert "Common LINE" in next(r["text"] for r in linededup.dedup_lines(df, keep="first").filter(f"doc_id = {first}").collect())
    with pytest.raises(ValueError):
        linededup.dedup_lines(df, min_docs=1)


def test_many_keys_meet_in_a_join_and_full_filters_change_nothing(planted, monkeypatch):
    rows, df = planted
    monkeypatch.setattr(linededup, "KEYS", 0)
    monkeypatch.setattr(linededup, "FILTER_BITS", 1 << 13)
    monkeypatch.setattr(linededup, "FAN", 2)
    assert got(linededup.digests(df)) == brute(rows)
    a = [r["text"] for r in linededup.dedup_lines(df, 1, 10, keep="first").collect()]
    assert sum(t.lower().count("common line") for t in a) == 1


def test_equals_sql(small_docs):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({linededup.oracle_sql()})").fetchall()
    assert got(linededup.digests(small_docs)) == sorted(want, key=str) and any(r[2] for r in want)


def test_the_second_filter_has_no_false_negative_and_few_false_positives(spark):
    rng = np.random.default_rng(2)
    once, twice = rng.integers(-(2**63), 2**63 - 1, 20_000), rng.integers(-(2**63), 2**63 - 1, 500)
    rows = [([int(h) for h in once[i::50]] + [int(h) for h in twice[i % 25 :: 25]],) for i in range(50)]
    filter_ = linededup.twice_filter(spark.createDataFrame(rows, "hashes array<long>").repartition(9), 21_000)
    bits = len(filter_) * 8
    assert linededup._has(filter_, linededup._places(twice, bits)).all() and linededup._has(filter_, linededup._places(once, bits)).mean() < 0.01
