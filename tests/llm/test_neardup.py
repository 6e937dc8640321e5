import itertools
import math
import random
import re

import pytest

from strandframe.llm import neardup


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def shingled(text, width):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width, percent):
    sets = {i: shingled(t, width) for i, t in rows if i is not None}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def edited_groups(seed=4):
    """Copies of one text, each edited its own way: many near it, few near each other; and copies of copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(3):
        base = [rng.choice(vocabulary) for _ in range(150)]
        for _ in range(100):
            rate = rng.choice([0, 0.01, 0.02, 0.04, 0.06])
            rows.append((3 * len(rows) + 1, " ".join(rng.choice(vocabulary) if rng.random() < rate else w for w in base)))
        rows += [(3 * (len(rows) + k) + 1, rows[-1][1].replace(base[5 + k], "zz")) for k in range(10)]
    rng.shuffle(rows)
    return rows


ODD = [(900000, None), (900001, ""), (900002, " one two "), (900003, "ONE\ttwo"), (900004, "a b c d"), (None, "a b c d"), (900005, "a b c d"), (900005, "a b c d")]


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_components_match_brute_force(spark, width, percent):
    rows = edited_groups() + ODD
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, rep int, component string")
    want = brute(rows, width, percent)
    got = neardup.near_duplicates(df, width, percent).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (*want[r["doc_id"]], want[r["doc_id"]][1] == r["doc_id"])
    kept = neardup.deduplicated(df, width, percent)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {None} | {i for i, (_, c) in want.items() if i == c}


def test_rows_that_share_an_id_are_decided_by_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near_b = b + " more"
    rows = [(1, a), (1, a), (5, a), (7, b), (7, a), (9, near_b), (11, c), (11, c), (12, ""), (12, ""), (None, a), (None, a)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component string").repartition(3)
    kept = neardup.deduplicated(df)
    assert kept.columns == df.columns
    want = [(1, a), (7, b), (11, c), (12, ""), (12, ""), (None, a), (None, a)]
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == sorted((str(i), t) for i, t in want)
    found = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect() if r["n_shingles"] and r["doc_id"])
    assert found == [(1, 1, False), (1, 1, True), (5, 1, False), (7, 1, False), (7, 7, True), (9, 7, False), (11, 11, False), (11, 11, True)]


def passage_family(n, seed=8):
    """Texts that share a passage, and some copies of them with an edit that they all have."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(90)]
    rows = []
    for i in range(n):
        own = [rng.choice(vocabulary) for _ in range(60)]
        rows.append((2 * i + 1, " ".join(passage + own)))
        if i % 10 == 0:
            rows.append((100_000 + i, " ".join([*passage[:40], "common", *passage[41:], *own])))
    return rows


def test_texts_that_share_a_passage(spark, monkeypatch):
    rows = passage_family(300)
    monkeypatch.setattr(neardup, "CROWD", 4)
    want = brute(rows, 3, 85)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert any(w[1] != i for i, w in want.items() if i >= 100_000)


def test_crowded_lists_lose_no_pair_that_agrees(spark, monkeypatch):
    rng = random.Random(2)
    # Signatures of a family: each value is the family's with a probability, else the text's own.
    common, threshold = list(range(1, 25)), 4
    signatures = {i: [c if rng.random() < 0.12 else 1000 * i + c for c in common] for i in range(1, 400)}
    signatures |= {i + 1000: [c if rng.random() < 0.8 else 5_000_000 + 1000 * i + k for k, c in enumerate(signatures[i])] for i in range(1, 400, 7)}
    of = {v: [i for i, s in signatures.items() if v in s] for v in common[:6]}
    members = [(v, i, 100 + i % 7, i % 5 == 0, i % 1000 // 2) for v, ids in of.items() for i in ids]
    frame = spark.createDataFrame(members, "value long, rep long, n_shingles int, known boolean, component long")
    classes = spark.createDataFrame(list(signatures.items()), "rep long, signature array<long>")
    agree = {(a, b) for ids in of.values() for a, b in itertools.combinations(sorted(ids), 2) if len(set(signatures[a]) & set(signatures[b])) >= threshold and a % 1000 // 2 != b % 1000 // 2 and not (a % 5 == 0 == b % 5)}
    found = {}
    for crowd in (10, 10_000):
        monkeypatch.setattr(neardup, "CROWD", crowd)
        found[crowd] = {tuple(r) for r in neardup.apart(frame, classes, threshold, 80).collect()}
    assert agree and agree <= found[10] <= found[10_000] and len(found[10]) < len(found[10_000]) / 3


def test_whole_table(small_docs):
    want = brute([(r["doc_id"], r["text"]) for r in small_docs.collect()], 3, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(small_docs, 3, 85).collect()} == want


def test_empty(empty):
    assert neardup.near_duplicates(empty).count() == 0


def test_threshold_is_safe():
    for percent in (50, 80, 85, 95):
        rows = neardup.signature_rows(percent)
        t, p = neardup.agreement_threshold(percent / 100, rows), (percent / 100) ** rows
        missed = sum(math.comb(neardup.COORDINATES, k) * p**k * (1 - p) ** (neardup.COORDINATES - k) for k in range(t))
        assert t >= neardup.LEAST and missed < neardup.LOSS


def test_pieces_of_a_popular_row_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(neardup, "PIECE", 16)
    pairs = [(1, i) for i in range(2, 300)] + [(7, 8), (9, 10), (400, 1)]
    sides = spark.createDataFrame([(i, i * 10) for i in range(1, 401)], "rep long, v long")
    got = neardup._in_pieces(spark.createDataFrame(pairs, "a long, b long"), sides, "v").collect()
    assert sorted(map(tuple, got)) == sorted((a, b, a * 10, b * 10) for a, b in pairs)


def test_rows_without_places_of_their_own_are_staged(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(50))
    spark.createDataFrame([(1, text, "m"), (2, text + " more", "n")], "doc_id long, text string, _metadata string").coalesce(1).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    assert [r["doc_id"] for r in neardup.deduplicated(docs).collect()] == [1]
    twice = docs.drop("_metadata").crossJoin(spark.range(2).select("id"))  # rows of one place, twice
    assert [(r["doc_id"], r["text"]) for r in neardup.deduplicated(twice).collect()] == [(1, text)]
