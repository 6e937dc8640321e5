"""Quality control, adapters, samples by near barcodes, FASTA in splits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandframe.model import InputError
from strandframe.operators import adapters, quality, reads, validate
from strandframe.sinks import files as sinks
from strandframe.sources import files

READS = "qname string, mate int, seq string, qual string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_start(seq, adapter, min_overlap, rate):
    best = None
    for s in range(len(seq)):
        for end in range(s, len(seq) + 1):
            for j in {len(adapter)} | (set(range(min_overlap, len(adapter))) if end == len(seq) else set()):
                e = distance(seq[s:end], adapter[:j]) if abs(end - s - j) <= j * rate else 99
                if e <= int(j * rate + 1e-9):
                    best = max(best or (-99,), (j - e, -e, -s))
    return None if best is None else -best[2]


@pytest.mark.parametrize("adapter,overlap,rate", [("AGATCGGAAGAG", 3, 0.1), ("ACGTACGTACGTACGTACGTAC", 1, 0.1), ("TTAGC", 5, 0.0)])
def test_adapters_equal_brute_force(spark, adapter, overlap, rate):
    rng = np.random.default_rng(len(adapter))

    def changed(x):
        x = list(x)
        for _ in range(rng.integers(0, 3)):
            i = int(rng.integers(0, len(x)))
            x[i : i + 1] = [["A"], [], ["C", "G"]][rng.integers(0, 3)]
        return "".join(x)

    def made(n):
        return "".join(rng.choice(list("ACGT"), n))

    seqs = [made(rng.integers(0, 30)) + changed(adapter)[: rng.integers(0, len(adapter) + 3)] + made(rng.choice([0, 0, 5])) for _ in range(150)] + [made(rng.integers(0, 12)) for _ in range(20)] + [adapter, adapter[:4], "", "A"]
    if rate:
        seqs += [made(61) + adapter + made(70), made(200) + adapter[:-1], made(127) + changed(adapter) + "ACG"]
    df = spark.createDataFrame([(str(i), 1, s, "I" * len(s)) for i, s in enumerate(seqs)] + [("none", 1, None, None)], READS)
    got = {r["qname"]: r for r in adapters.adapter_trim(df, adapter, overlap, rate).collect()}
    for i, s in enumerate(seqs):
        at = brute_start(s, adapter, overlap, rate)
        assert got[str(i)]["adapter_at"] == at, s
        assert got[str(i)]["seq"] == (s if at is None else s[:at]) and len(got[str(i)]["qual"]) == len(got[str(i)]["seq"])
    assert got["none"]["seq"] is None
    with pytest.raises(ValueError):
        adapters.adapter_start(F.col("seq"), "ACGT", 5)


def test_pairs_stay_together_and_adapters_are_found(spark):
    adapter, other = adapters.ADAPTERS["illumina"], adapters.ADAPTERS["nextera"]
    insert = "ACGTTGCAACGGTTACCATG"
    rows = [("a", 1, insert + adapter, "I" * 33), ("a", 2, insert + other, "I" * 32), ("b", 1, insert, "I" * 20), ("b", 2, "ACG" + other, "I" * 15), ("c", 1, insert + "AAAA", "I" * 20 + "####"), ("c", 2, insert, "I" * 20), ("d", 1, insert, "I" * 20)]
    df = spark.createDataFrame(rows, READS)
    got = {(r["qname"], r["mate"]): r["seq"] for r in adapters.trimmed_pairs(df, adapter, other, cutoff=20, least=15).collect()}
    assert got == {(q, m): insert for q in "ac" for m in (1, 2)}
    assert {r["adapter"]: r["reads"] for r in adapters.adapter_counts(df).collect()} == {"illumina": 1, "nextera": 2, "small_rna": 0}
    assert adapters.detected_adapter(df) == other and adapters.detected_adapter(df.filter("qname = 'd'")) is None
    assert adapters.trimmed_pairs(df.limit(0), adapter).count() == 0


def test_quality_control(spark):
    rows = [("a", 1, "ACGT", "!!II"), ("b", 1, "ACN", "I#I"), ("c", 1, "", ""), ("d", 1, None, None), ("e", 1, "AA", "I")]
    df = spark.createDataFrame(rows, READS)
    counts = quality.cycle_counts(df)
    assert sorted(map(tuple, counts.filter("cycle = 2").collect()), key=str) == sorted([(2, "C", 0, 1), (2, "C", 2, 1), (2, "A", None, 1)], key=str)
    assert {r["cycle"]: (r["p10"], r["p50"], r["p90"]) for r in quality.cycle_percentiles(counts).collect()} == {1: (0, 40, 40), 2: (0, 0, 2), 3: (40, 40, 40), 4: (40, 40, 40)}
    third = next(r for r in quality.base_composition(counts).collect() if r["cycle"] == 3)
    assert (third["G"], third["N"], third["A"], third["other"]) == (0.5, 0.5, 0.0, 0.0)
    assert {r["length"]: r["reads"] for r in quality.length_histogram(df).collect()} == {4: 1, 3: 1, 0: 2, 2: 1}
    assert {r["gc"]: r["reads"] for r in quality.gc_histogram(df).collect()} == {50: 1, 33: 1, 0: 1}
    assert {r["quality"]: r["reads"] for r in quality.read_quality_histogram(df).collect()} == {20: 1, 27: 1, 40: 1}
    assert quality.cycle_quality(df.limit(0)).count() == 0 and quality.kmer_enrichment(df.limit(0)).count() == 0


def test_heavy_hitters_are_exact_whatever_buckets_they_share(spark):
    values = ["hot"] * 300 + [f"v{i % 37}" for i in range(370)] + [f"rare{i}" for i in range(330)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "seq string").repartition(5)
    for buckets in (1, 16, 1 << 20):
        assert {r["seq"]: r["n"] for r in quality.heavy_hitters(df, "seq", 0.01, buckets).collect()} == {"hot": 300, **{f"v{i}": 10 for i in range(37)}}
    top = quality.overrepresented(df, 0.3).collect()
    assert [(r["seq"], r["n"], r["share"]) for r in top] == [("hot", 300, 0.3)]
    assert quality.heavy_hitters(df.limit(0), "seq", 0.1).count() == 0


def test_kmers_enriched_at_a_cycle(spark):
    rng = np.random.default_rng(3)
    rows = [(str(i), 1, "".join(rng.choice(list("ACGT"), 10)) + ("GATTA" if i % 2 else "") + "".join(rng.choice(list("ACGT"), 10)), "") for i in range(400)]
    got = {r["kmer"]: r for r in quality.kmer_enrichment(spark.createDataFrame(rows, READS), 5, 50).collect()}
    assert got["GATTA"]["cycle"] == 11 and got["GATTA"]["at_cycle"] >= 200 and got["GATTA"]["ratio"] > 10
    seq = "ACGTN" * 3
    assert [r[0] for r in spark.range(1).select(F.explode(quality.kmers(F.lit(seq), 4))).collect()] == [seq[i : i + 4] for i in range(12)]


def test_near_barcodes(spark):
    barcodes = spark.createDataFrame([("s1", "AAAACCCC"), ("s2", "GGGGTTTT"), ("s3", "GGGGTTTTAC"), ("s4", "AAAACCGG"), ("s5", "TTTTTTTT"), ("s6", "TTTTTTTT")], "sample_id string, barcode string")
    tail = "GATTACA"
    want = {
        "AAAACCCC" + tail: ("s1", 0, tail), "AAATCCCC" + tail: ("s1", 1, tail), "AAACCCC" + tail: ("s1", 2, tail), "GAAAACCCC" + tail: ("s1", 3, tail), "AAAAGCCCC" + tail: ("s1", 1, "C" + tail), "NAAACCCC" + tail: ("s1", 1, tail),
        "GGGGTTTTAC" + tail: ("s3", 0, tail), "GGGGTTTTG": ("s2", 0, "G"), "AAAACCCG" + tail: (None, None, "AAAACCCG" + tail), "CCCCCCCC" + tail: (None, None, "CCCCCCCC" + tail), "TTTTTTTT" + tail: (None, None, "TTTTTTTT" + tail), "": (None, None, ""),
    }
    df = spark.createDataFrame([(s, 1, s, "I" * len(s)) for s in want] + [("null", 1, None, None)], READS)
    got = {r["qname"]: (r["sample_id"], r["edit"], r["seq"]) for r in reads.demultiplex_near(df, barcodes).collect()}
    assert got == {**want, "null": (None, None, None)}
    assert reads.demultiplex_near(df, barcodes.limit(0)).filter("sample_id is null").count() == len(want) + 1


def test_a_folder_for_each_sample(spark, tmp_path):
    rows = [(f"q{i}", ["s 1", "a/b", "x+y%", None][i % 4], "ACGT", "IIII") for i in range(40)]
    df = spark.createDataFrame(rows, "qname string, sample_id string, seq string, qual string").coalesce(2)
    for zipped in (False, True):
        folder = str(tmp_path / f"out{zipped}")
        sinks.fastq_samples(df, folder, rows=3, compressed=zipped)
        back = files.fastq_samples(spark, folder)
        assert sorted((r["qname"], r["sample_id"]) for r in back.collect()) == sorted((r[0], r[1]) for r in rows)
        assert back.groupBy("sample_id", "file").count().agg(F.max("count")).first()[0] == 3


def test_fasta_in_splits(spark, tmp_path):
    rng = np.random.default_rng(8)
    records = [(f"ref{i} note>x", "".join(rng.choice(list("ACGT"), int(rng.integers(0, 400))))) for i in range(200)] + [("last", "ACGT"), ("ref7 note>x", "TTTT")]
    text = "".join(f">{n}\r\n" + "".join(s[i : i + 60] + "\r\n" for i in range(0, len(s), 60)) for n, s in records)
    (tmp_path / "a.fasta").write_text("stray line\n" + text)
    (tmp_path / "b.fasta").write_text("\n>only\nAC\n\nGT")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "777")
    try:
        lines = files.numbered_lines(spark, str(tmp_path / "a.fasta"), "\n>")
        assert lines.rdd.getNumPartitions() > 20
        got = {r["rname"]: r["sequence"] for r in files.fasta(spark, str(tmp_path)).collect()}
        first = {r["rname"] for r in files.fasta(spark, str(tmp_path / "a.fasta"), first_token=True).collect()}
        (tmp_path / "c").mkdir()
        (tmp_path / "c" / "c.fasta").write_text("".join(f">r{i}\n{'ACGT' * 9}\n" for i in range(300)) + ">bad\nACGU\n>bad2\nX\n")
        with pytest.raises(InputError, match="only A, C, G and T .line 601"):
            validate.require(validate.fasta_violations(spark, str(tmp_path / "c")), "c")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {**dict(records), "only": "ACGT"} and "ref3" in first and len(first) == 201


def test_the_first_bad_record_is_named(spark, tmp_path):
    (tmp_path / "x.fastq").write_text("".join(f"@q{i}\nACGT\n{'+' if i < 7 else 'x'}\nIIII\n" for i in range(20)))
    with pytest.raises(InputError, match="third line.*number 7"):
        validate.require(validate.fastq_violations(spark, str(tmp_path / "x.fastq")), "x")


def test_records_are_put_together_where_they_are_read(spark, tmp_path):
    text = "".join(f"@q{i}\n{'ACGT' * (i % 7 + 1)}\n+\n{'I@@@' * (i % 7 + 1)}\n" for i in range(500))
    (tmp_path / "a.fastq").write_text(text)
    (tmp_path / "b.fastq").write_text("@only\nACGT\n+\nIIII\n")
    (tmp_path / "c.fastq").write_text("@q\nAC\n+\nII\n@cut\nACGT\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        records = files.fastq_records(spark, str(tmp_path / "*.fastq"))
        assert "SortMergeJoin" not in records._jdf.queryExecution().executedPlan().toString()
        got = {(r["file"][-7:], r["number"]): (r["head"], r["seq"], r["plus"], r["qual"]) for r in records.collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    lines = text.splitlines()
    want = {("a.fastq", i): tuple(lines[4 * i : 4 * i + 4]) for i in range(500)}
    assert got == want | {("b.fastq", 0): ("@only", "ACGT", "+", "IIII"), ("c.fastq", 0): ("@q", "AC", "+", "II"), ("c.fastq", 1): ("@cut", "ACGT", None, None)}


@pytest.mark.parametrize("adapter,overlap,rate", [("ACGTTGCAACGTTG", 3, 0.1), ("ACGTTGCAAC", 2, 0.3), ("GGA", 1, 0.0)])
def test_adapters_are_found_as_without_the_test_of_pieces(spark, monkeypatch, adapter, overlap, rate):
    import random

    draw = random.Random(5)
    rows = []
    for _ in range(400):
        a = list(adapter)
        for _ in range(draw.randrange(3)):
            i = draw.randrange(len(a) + 1)
            a[i : i + draw.randrange(2)] = draw.choice(["", "A", "C", "G", "T"])
        text = "".join(draw.choice("ACGT") for _ in range(draw.randrange(20))) + "".join(a)[: draw.randrange(len(adapter) + 3)]
        rows.append((text + ("ACGT" * 5)[: draw.choice([0, 0, 7])],))
    df = spark.createDataFrame(rows, "seq string")
    got = df.select("seq", adapters.adapter_start(F.col("seq"), adapter, overlap, rate).alias("at"))
    assert "Contains(" in got._jdf.queryExecution().analyzed().toString() or "contains(" in got._jdf.queryExecution().analyzed().toString().lower()
    found = list(map(tuple, got.collect()))
    monkeypatch.setattr(adapters, "_any_in", lambda text, pieces: F.lit(True))
    assert found == list(map(tuple, df.select("seq", adapters.adapter_start(F.col("seq"), adapter, overlap, rate)).collect()))
    assert any(at is not None for _, at in found) and any(at is None for _, at in found)
