"""Conversation repair against brute force."""

import hashlib
import heapq
import re
import zlib

import duckdb
import numpy as np
import pytest

from strandframe.llm import convrepair

LEGAL = {"su", "ua", "au"}


def dijkstra(turns, start=0, goal=None, role=lambda state: {0: "u", 1: "u", 2: "a", 3: "u"}[state]):
    """The cheapest and least edits, by Dijkstra's search over (cost, edits); to a goal, none behind the last turn."""
    heap, done = [(0, "", 0, start)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if i == len(turns) and (state in (0, 3) if goal is None else state == goal):
            return cost, audit
        if (i, state) in done or goal is not None and i == len(turns):
            continue
        done.add((i, state))
        after = {"u": 2, "a": 3}[role(state)]
        heapq.heappush(heap, (cost + 2, audit + "I", i, after))
        if i < len(turns):
            initial, must_go, truncated = turns[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state))
            if not must_go:
                heapq.heappush(heap, (cost + 2 + truncated, audit + "R", i + 1, after))
                if initial == role(state) or initial == "s" and state == 0:
                    heapq.heappush(heap, (cost + truncated, audit + "K", i + 1, 1 if initial == "s" else after))


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        damaged = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            damaged += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen, turns = [], set(), []
        for _, role, text in damaged:
            bare = text.strip(" \t\n\x0b\f\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
            turns.append((role[:1], faults[-1] in ("blank", "duplicate"), faults[-1] == "truncated"))
        cost, audit = dijkstra(turns)
        numbers = [t for t, _, _ in damaged if t is not None]
        lines, at, state = [], iter(damaged), 0
        for e in audit:
            forced = "assistant" if state == 2 else "user"
            if e == "I":
                lines.append(forced + ":")
            else:
                _, role, text = next(at)
                if e == "D":
                    continue
                lines.append(f"{role if e == 'K' else forced}:{text}")
                if e == "K" and role[:1] == "s":
                    state = 1
                    continue
            state = 3 if state == 2 else 2
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(damaged, damaged[1:], strict=False))
        out[conv] = (gaps, *[faults.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    return {r["conv_id"]: tuple(r)[1:] for r in convrepair.digests(convrepair.damage(df)).collect()}


def made(seed, sizes):
    rng = np.random.default_rng(seed)
    texts = ["Hello there.", "Why?", "cut off", " ", "", None, "Sure!\n", "Ok. ", "été "] + [f"Answer {i}." for i in range(20)]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "User"]
    return [(conv, None if rng.random() < 0.05 else int(k if rng.random() < 0.9 else rng.integers(0, n)), roles[(k % 2) if rng.random() < 0.8 else rng.integers(0, len(roles))], texts[rng.integers(0, len(texts))]) for conv, n in sizes for k in range(n)]


SCHEMA = "conv_id long, turn long, role string, text string, extra int"


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = made(seed, [(i, i % 9) for i in range(150)] + [(None, 7), (1000, 128), (1001, 190), (1002, 300), (1003, 129)])
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(5)
    assert got(df) == brute(rows)


def test_one_conversation_of_one_turn_number_and_all_rows_the_same(spark):
    rows = [(1, None, "user", "Same."), *[(1, 5, "assistant", f"Text {i}.") for i in range(200)], *[(1, 5, "user", "Same.")] * 150, (2, 1, "user", "Hi."), (2, 2, "assistant", "Yes.")]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(6)
    assert got(df) == brute(rows)


def test_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert got(df) == {}
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(dropped, 0, "user", "Hi.", 1)], SCHEMA)
    assert got(one) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_search_equals_dijkstra():
    rng = np.random.default_rng(9)
    for _ in range(2000):
        turns = [("suat "[rng.integers(0, 5)], bool(rng.random() < 0.2), False) for _ in range(rng.integers(0, 12))]
        turns = [(i, m, not m and bool(rng.random() < 0.3)) for i, m, _ in turns]
        assert convrepair.search(turns) == dijkstra(turns)
        for start in range(4):
            for goal in (None, 0, 1, 2, 3):
                want = dijkstra(turns, start, goal)
                assert convrepair.search(turns, start, goal) == want
                assert want is None or convrepair.lower_bounds(turns, goal)[0][start] <= want[0]


def test_table_equals_brute_force_and_sql(spark):
    path = "/root/testdata/sf0.01/conversations.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    rows = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    sql = {r[0]: r[1:] for r in con.execute(f"SELECT {', '.join(names)} FROM ({convrepair.oracle_sql()})").fetchall()}
    want = brute(rows)
    assert got(spark.read.parquet(path)) == want
    assert sql == want
