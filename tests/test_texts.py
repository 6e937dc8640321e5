"""Vectors made as text, against those made as arrays."""

import random

import pytest
from pyspark.sql import functions as F

from strandframe.functions import texts
from strandframe.model import BitVectorConfig, StricterConstraints
from strandframe.operators import filters, histogram, vectors
from strandframe.sinks import files as sinks
from strandframe.sources import files

REFS = [("a", "ACGTTGCAACGGTTACGATTTTTACGACGACGTAGCATGCATCGAACCTTGGAACC"), ("b", "TTTTTTTTTTTTTTTTTTTTTTTTTTTTTTTTTT"), ("empty", ""), ("wide", "ACGTéACGTACGTACGTACGTACGTACGTACGT")]


def odd_reads(n, seed=1):
    rng, out = random.Random(seed), []
    for k in range(n):
        ops = "".join(f"{rng.choice([0, 1, 1, 2, 3, 5, 10])}{rng.choice('MMMMMMMDDIISSNHP=X*Z' if rng.random() < 0.2 else 'MMMDIS')}" for _ in range(rng.randint(0, 6)))
        size = rng.choice([60, 60, 60, rng.randint(0, 40)])
        seq, qual = "".join(rng.choice("ACGTACGTACGTN") for _ in range(size)), "".join(rng.choice("5:;>?@ABC") for _ in range(rng.choice([size, size, size, size // 2])))
        seq = rng.choice([seq] * 12 + [seq.lower(), seq.replace("A", "."), seq.replace("C", "1"), seq.replace("G", "é"), None])
        out.append((f"q{k}", rng.choice("aaaab") if rng.random() < 0.95 else rng.choice(["empty", "wide"]), rng.choice([1, 2, 5, 9, 20, 50] if rng.random() < 0.9 else [0, -3, None]), rng.choice([0, 14, 15, 40]), rng.choice([ops] * 8 + ["*", "10M", None]), seq, rng.choice([qual] * 9 + [None])))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    reads = spark.createDataFrame(odd_reads(1500), "qname string, rname string, pos int, mapq int, cigar string, seq string, qual string").repartition(3)
    return reads, spark.createDataFrame(REFS, "rname string, sequence string")


@pytest.mark.parametrize("mode", ["basic", "sam"])
def test_texts_are_the_arrays(tables, mode):
    config = BitVectorConfig(cigar_mode=mode)
    known = vectors.with_reference(*tables)
    cells = [F.col(c) for c in ("cigar", "pos", "seq", "qual", "sequence")]
    both = known.select(texts.vector_text(*cells, vectors._MODES[mode], 25, 10).alias("text"), vectors.read_bits(*cells, config).alias("bits"), "pos")
    made = both.filter("text is not null").select("text", F.col("bits").eqNullSafe(texts.bits_of(F.col("text"), F.col("pos"))).alias("same")).collect()
    assert all(r["same"] for r in made) and sum(r["text"] != "" for r in made) > 300 and any("1" in r["text"] for r in made)


def test_fragments_have_the_arrays(tables):
    cells = [F.col(c) for c in ("cigar", "pos", "seq", "qual", "sequence")]
    want = {r["qname"]: r["bits"] for r in vectors.with_reference(*tables).select("qname", vectors.read_bits(*cells).alias("bits")).collect()}
    assert {r["qname"]: r["bits"] for r in vectors.single_fragments(*tables).collect()} == want


def plain(tables, config=BitVectorConfig()):
    """Fragments judged by arrays alone."""
    known = vectors.with_reference(*tables).withColumn("mapqs", F.array("mapq")).withColumn("lengths", F.array(F.length("seq"))).withColumn("seqs", F.array("seq"))
    bits = vectors.read_bits(*(F.col(c) for c in ("cigar", "pos", "seq", "qual", "sequence")), config)
    return filters.with_reason(known.select(*vectors._FRAGMENT, bits.alias("bits")), config)


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("stricter", [None, StricterConstraints(2, 0.1, 4)])
def test_packed_fragments_count_alike(tables, stricter):
    config, tables = BitVectorConfig(stricter=stricter), (tables[0].filter("rname <> 'empty'"), tables[1])
    packed, want = filters.with_reason(vectors.single_fragments(*tables, config, packed=True), config), plain(tables, config)
    assert packed.filter("text is not null and bits is null").count() > 300 and packed.filter("text is null and size(bits) > 0").count() > 30
    assert rows(packed.select("qname", "n_mut", "reason")) == rows(want.select("qname", "n_mut", "reason"))
    assert rows(histogram.positions(packed)) == rows(histogram.positions(want))
    assert rows(histogram.tallies(packed)) == rows(histogram.tallies(want))


def test_packed_fragments_are_written_alike(spark, tables, tmp_path):
    reads, refs = tables
    known = reads.filter("rname <> 'empty'"), refs
    packed = filters.with_reason(vectors.single_fragments(*known, packed=True))
    for name, judged in (("packed", packed), ("plain", plain(known))):
        sinks.bit_vectors_text(judged, str(tmp_path / name))
        sinks.joined_bit_vectors(spark, [str(tmp_path / name / "*" / "*")], str(tmp_path / f"{name}-all"))
    lines = {n: sorted(r["value"] for r in spark.read.text(str(tmp_path / n / "*" / "*")).collect()) for n in ("packed", "plain", "packed-all", "plain-all")}
    assert lines["packed"] == lines["plain"] and lines["packed-all"] == lines["plain-all"] and len(lines["plain"]) > 300
    back = files.bit_vector_text(spark, str(tmp_path / "plain" / "*" / "*")).select("qname", "rname", F.inline("bits"))
    assert rows(texts.symbols(files.bit_vector_text(spark, str(tmp_path / "plain" / "*" / "*"), packed=True), "qname", "rname")) == rows(back)


def test_long_reads_are_cut_into_pieces(spark, monkeypatch):
    import pyarrow as pa

    reads = [r for r in odd_reads(300, 2) if r[1] in "ab"]
    own = dict(REFS)
    columns = [pa.array([r[i] for r in reads], k) for i, k in ((4, pa.string()), (2, pa.int32()), (5, pa.string()), (6, pa.string()))] + [pa.array([own[r[1]] for r in reads])]
    whole = texts.vector_texts(*columns, vectors._MODES["basic"], 25, 10)
    monkeypatch.setattr(texts, "SYMBOLS", 7)
    assert texts.vector_texts(*columns, vectors._MODES["basic"], 25, 10).equals(whole) and whole.null_count < len(reads) * 0.8
    assert texts.vector_texts(*[c.slice(20, 50) for c in columns], vectors._MODES["basic"], 25, 10).equals(whole.slice(20, 50))
    assert len(texts.vector_texts(*[c.slice(0, 0) for c in columns], vectors._MODES["basic"], 25, 10)) == 0


def test_text_files_need_no_vectors_to_be_described(tables, tmp_path, monkeypatch):
    """The headers of text files are made without a look at the vectors."""
    plans = []
    stage = sinks.stage
    monkeypatch.setattr(sinks, "stage", lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or stage(df, *a))
    sinks.bit_vectors_text(filters.with_reason(vectors.single_fragments(tables[0], tables[1], packed=True)), str(tmp_path / "text"))
    assert len(plans) == 1 and "Generate" not in plans[0] and "ArrowEvalPython" not in plans[0]


def odd_pairs(n, seed=3):
    """Mates of odd_reads(), most of which agree."""
    rng, out = random.Random(seed), []
    a, b = odd_reads(n, seed), odd_reads(n, seed + 1)
    for one, two in zip(a, b, strict=True):
        rname, mapq, p1, p2 = one[1], one[3], one[2] or 4, two[2] or 4
        one = (*one[:2], p1, *one[3:])
        two = (one[0], rname, p2, mapq if rng.random() < 0.9 else 7, *two[4:])
        out.append((*one, "=", p2 if rng.random() < 0.9 else 3, 1))
        out += [(*two, "=", p1, 2)] * rng.choice([0, 1, 1, 1, 1, 1, 1, 1, 1, 2])
    return out


def test_mates_merge_as_texts(spark, tables):
    """Pairs whose vectors move as text are those that meet as reads."""
    mates = spark.createDataFrame(odd_pairs(1500), "qname string, rname string, pos int, mapq int, cigar string, seq string, qual string, rnext string, pnext int, mate int").repartition(3)
    packed = filters.with_reason(vectors.packed_pair_fragments(mates, tables[1]))
    want = filters.with_reason(vectors.paired_fragments(vectors.consistent_pairs(mates), tables[1]))
    accepted = packed.filter("reason is null").select("qname", "rname", "n_mut", F.coalesce(texts.bits_of(F.col("text"), F.col("start")), "bits").alias("bits"))
    assert rows(accepted) == rows(want.filter("reason is null").select(*accepted.columns))
    assert packed.filter("text <> '' and text is not null and reason is null").count() > 30
    assert rows(packed.select("qname", "rname", "ref_length", "mapqs", "lengths", "reason")) == rows(want.select("qname", "rname", "ref_length", "mapqs", "lengths", "reason"))
    assert rows(histogram.positions(packed)) == rows(histogram.positions(want))
    with pytest.raises(Exception, match="unknown reference: b"):
        vectors.packed_pair_fragments(mates, tables[1].filter("rname <> 'b'")).collect()


def test_every_two_symbols_merge(spark):
    from strandframe.functions.columns import resolve_bits

    symbols = [*texts.LETTERS, "?", "1", "0", "*"]
    df = spark.createDataFrame([(a, b, s) for a in symbols for b in symbols for s in (1, 2, 9, 5000)], "a string, b string, s int")
    one, two = F.col("a"), F.concat("b", "a")  # b stands at s, a behind it
    merged = df.select("a", "b", "s", texts.merged_text(F.lit(2), one, F.col("s"), two).alias("text"), texts.merged_start(F.lit(2), one, F.col("s"), two).alias("start"), resolve_bits(F.col("a"), F.col("b")).alias("met"))
    for r in merged.collect():
        want = {1: r["b"] + r["a"], 2: r["met"] + r["a"], 9: r["a"] + "." * 6 + r["b"] + r["a"], 5000: None}[r["s"]]
        assert (r["text"], r["start"]) == (want, min(2, r["s"]))


@pytest.mark.parametrize("name", ["mutation_rate", "pop_avg"])
def test_counts_by_position_are_made_of_texts(spark, name):
    from strandframe.plans import catalogue

    plan = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan


def test_whole_and_merged_counts_are_made_of_texts(spark, monkeypatch):
    from strandframe.plans import catalogue

    met = []
    monkeypatch.setattr(catalogue.reports, "block_differences", lambda a, b, keys: met.extend((a, b)) or a)
    catalogue.impl_diff(spark, "/root/testdata/sf0.001")
    assert len(met) == 2 and all("ArrowEvalPython" in df._jdf.queryExecution().executedPlan().toString() for df in met)


def test_text_files_are_read_back_as_text(spark, monkeypatch):
    from strandframe.plans import catalogue

    asked, read = [], files.bit_vector_text
    monkeypatch.setattr(catalogue.files, "bit_vector_text", lambda *a, **b: asked.append(b) or read(*a, **b))
    assert catalogue.text_roundtrip(spark, "/root/testdata/sf0.001").columns == ["qname", "rname", "pos", "bit"] and asked == [{"packed": True}]
