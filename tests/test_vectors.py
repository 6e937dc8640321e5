"""Vectors against a plain restatement for single reads."""

import random
import re

import pytest
from pyspark.sql import functions as F

from strandframe.functions.columns import deletion_is_ambiguous, resolve_bits
from strandframe.model import BitVectorConfig
from strandframe.operators import render, vectors


def plain_ambiguous(ref, end, n, around=10):
    lo, hi = end - n - around, end + around
    return any(ref[lo : e - n] + ref[e:hi] == ref[lo : end - n] + ref[end:hi] for e in range(end - n, end + n + 1) if e != end)


def plain_bits(ref, pos, cigar, seq, qual, cutoff=25):
    out, i, j = {}, pos, 0
    ops = re.findall(r"(\d+)([A-Z])", cigar)
    if any(op not in "MDIS" for _, op in ops):
        return {}
    for k, (n, op) in enumerate(ops):
        n = int(n)
        if op == "M":
            for x in range(n):
                out[i + x] = "?" if ord(qual[j + x]) - 33 <= cutoff else "0" if seq[j + x] == ref[i + x - 1] else seq[j + x]
            i, j = i + n, j + n
        elif op == "D":
            for x in range(n):
                out[i + x] = "?"
            if n and not plain_ambiguous(ref, i + n - 1, n):
                out[i + n - 1] = "1"
            i += n
        else:
            j += n
            if op == "S" and k == len(ops) - 1:
                for x in range(n):
                    out[i + x] = "*"
                i += n
    return out


def plain_merge(a, b):
    if a is None or b is None or a == b:
        return b if a is None else a
    if "0" in (a, b):
        return "0"
    for s in "?*":
        if s in (a, b):
            return b if a == s else a
    letters = sum(x in "ACGT" for x in (a, b))
    return "?" if letters == 2 or letters == 1 and "1" in (a, b) else a


CIGARS = ["134M12S", "80M1D53M12S", "43M1I91M12S", "10M5N10M", "20M5H10M", "10=5X10M", "*", "", "10Z5M", "10m5M", "ABC", "10", "5S20M3D10M", "0M5M", "3D10M"]


def test_reads_match_the_restatement(spark):
    rng = random.Random(3)
    rows = []
    for n, cigar in enumerate(CIGARS * 6):
        ref = "".join(rng.choice("ACGT" if n % 2 else "AC") for _ in range(160))
        size = sum(int(k) for k, op in re.findall(r"(\d+)([A-Z=])", cigar) if op != "D") + 5
        rows.append((n, ref, rng.randint(1, 12), cigar, "".join(rng.choice("ACGTN") for _ in range(size)), "".join(rng.choice("5:;?I") for _ in range(size))))
    df = spark.createDataFrame(rows, "n int, sequence string, pos int, cigar string, seq string, qual string")
    got = df.select("n", vectors.read_bits(*(F.col(c) for c in ("cigar", "pos", "seq", "qual", "sequence"))).alias("bits")).collect()
    want = {r[0]: plain_bits(r[1], r[2], r[3], r[4], r[5]) for r in rows}
    for row in got:
        assert {b["pos"]: b["bit"] for b in row["bits"]} == want[row["n"]]
        assert [b["pos"] for b in row["bits"]] == sorted(want[row["n"]])


def test_deletion_ambiguity(spark):
    rng = random.Random(5)
    refs = ["A" * 40, "AC" * 25, "ACGTTGCATCGA", *("".join(rng.choice("ACGT") for _ in range(rng.randint(12, 64))) for _ in range(12))]
    cases = [(r, e, n) for r in refs for n in (1, 2, 3, 6) for e in range(n, len(r) + 1, 3)]
    df = spark.createDataFrame(cases, "r string, e int, n int")
    got = df.select("r", "e", "n", deletion_is_ambiguous(F.col("r"), F.col("e"), F.col("n"), 10).alias("x")).collect()
    assert all(g["x"] == plain_ambiguous(g["r"], g["e"], g["n"]) for g in got)
    assert {g["x"] for g in got} == {True, False}


def test_conflicts(spark):
    symbols = [*"ACGTN01?*", None]
    df = spark.createDataFrame([(a, b) for a in symbols for b in symbols], "a string, b string")
    for r in df.select("a", "b", resolve_bits(F.col("a"), F.col("b")).alias("x")).collect():
        assert r["x"] == plain_merge(r["a"], r["b"]), r


def test_clip_reaches_past_the_reference(spark):
    ref = "ACGT" * 33 + "AC"
    df = spark.createDataFrame([("134M12S", 1, ref + "A" * 12, "I" * 146, ref)], "cigar string, pos int, seq string, qual string, sequence string")
    row = df.select(vectors.read_bits(*(F.col(c) for c in ("cigar", "pos", "seq", "qual", "sequence"))).alias("b"), render.dense_text(vectors.read_bits(*(F.col(c) for c in ("cigar", "pos", "seq", "qual", "sequence"))), F.lit(1), F.lit(134)).alias("t")).first()
    assert len(row["b"]) == 146 and [b["bit"] for b in row["b"][134:]] == ["*"] * 12 and row["t"] == "0" * 134


def test_sam_mode(spark):
    ref = "ACGT" * 10
    df = spark.createDataFrame([("5=2X3N2H4M", 1, ref[:5] + "AA" + ref[10:14], "I" * 11, ref)], "cigar string, pos int, seq string, qual string, sequence string")
    config = BitVectorConfig(cigar_mode="sam")
    bits = df.select(vectors.read_bits(*(F.col(c) for c in ("cigar", "pos", "seq", "qual", "sequence")), config).alias("b")).first()["b"]
    assert [b["pos"] for b in bits] == list(range(1, 15)) and "".join(b["bit"] for b in bits[:5]) == "00000"


def test_dense_text_and_back(spark):
    df = spark.createDataFrame([("..0A?1*.",), ("",)], "t string")
    got = df.select("t", render.from_dense(F.col("t"), F.lit(3)).alias("b")).select("t", render.dense_text(F.col("b"), F.lit(3), F.lit(10)).alias("u"), F.size("b").alias("n")).collect()
    assert (got[0]["u"], got[0]["n"], got[1]["n"]) == ("..0A?1*.", 5, 0)


def test_config():
    assert BitVectorConfig.from_dict({"qscore_cutoff": 20, "stricter": {"min_mut_distance": 3}}).stricter.min_mut_distance == 3
    with pytest.raises(Exception, match="unknown"):
        BitVectorConfig.from_dict({"nonsense": 1})
    with pytest.raises(Exception, match="format"):
        BitVectorConfig(storage_format="xml")


def test_text_of_vectors_with_and_without_gaps(spark):
    from strandframe.operators import render

    rows = [([(1, "0"), (2, "A"), (3, "?")], 5), ([(-1, "0"), (2, "A"), (4, "1"), (7, "C")], 5), ([], 3), ([(4, "G"), (5, "*")], 5), ([(9, "A")], 2)]
    df = spark.createDataFrame(rows, "bits array<struct<pos:int,bit:string>>, n int")
    text = render.dense_text(F.col("bits"), F.lit(1), F.col("n"))
    assert [r[0] for r in df.select(text).collect()] == ["0A?..", ".A.1.", "...", "...G*", ".."]
    assert [r[0] for r in df.select(render.letter_count(F.col("bits"), F.lit(1), F.col("n"))).collect()] == [1, 1, 0, 1, 0]
    assert "repeat(" in df.select(text)._jdf.queryExecution().analyzed().toString()  # a vector without gaps isn't looked up
