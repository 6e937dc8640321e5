"""Reuse, merge and comparison of results, scans of many files, mates of a stream."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from strandframe.operators import chunks, histogram, merge, reports, reuse, vectors
from strandframe.sinks import files as sinks
from strandframe.sources import files
from strandframe.streaming import mates


@pytest.fixture()
def store(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("1\n2\n")
    calls = []

    def make():
        calls.append(1)
        return {"sum": spark.read.text(str(tmp_path / "in")).agg(F.sum(F.col("value").cast("int")).alias("s")), "all": spark.read.text(str(tmp_path / "in"))}

    return reuse.ResultStore(spark, str(tmp_path / "store")), [str(tmp_path / "in")], make, calls, tmp_path


def test_a_second_run_reads_no_input(store):
    results, inputs, make, calls, tmp = store
    one = results.reuse("n", inputs, {"a": 1, "b": 2}, make)
    two = results.reuse("n", inputs, {"b": 2, "a": 1}, make)
    assert len(calls) == 1 and two["sum"].first()["s"] == one["sum"].first()["s"] == 3 and sorted(two) == ["all", "sum"]
    assert all("/store/data/" in f for df in two.values() for f in df.inputFiles())


def test_what_is_a_miss(spark, store):
    results, inputs, make, calls, tmp = store
    results.reuse("n", inputs, {"a": 1}, make)
    results.reuse("n", inputs, {"a": 2}, make)
    results.reuse("m", inputs, {"a": 1}, make)
    reuse.ResultStore(spark, str(tmp / "store"), version="other").reuse("n", inputs, {"a": 1}, make)
    assert len(calls) == 4
    (tmp / "in" / "a.txt").write_text("1\n5\n")
    os.utime(tmp / "in" / "a.txt", (1, 1))
    assert results.reuse("n", inputs, {"a": 1}, make)["sum"].first()["s"] == 6 and len(calls) == 5
    (tmp / "in" / "b.txt").write_text("10\n")
    assert results.reuse("n", inputs, {"a": 1}, make)["sum"].first()["s"] == 16 and len(calls) == 6
    assert results.reuse("n", inputs, {"a": 1}, make, overwrite=True)["sum"].first()["s"] == 16 and len(calls) == 7
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        results.key("n", [str(tmp / "nothing")], {})


def test_a_run_that_broke_off_is_a_miss(spark, store):
    results, inputs, make, calls, tmp = store

    def breaks():
        bad = spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("x"))
        return {"first": spark.range(5), "second": bad}

    with pytest.raises(Exception, match="broken"):
        results.reuse("n", inputs, {}, breaks)
    key = results.key("n", inputs, {})
    assert any((tmp / "store" / "data" / key).iterdir()) and results.get(key) is None
    (tmp / "store" / "manifests" / key / "half" / "_temporary").mkdir(parents=True)
    assert results.get(key) is None
    assert results.reuse("n", inputs, {}, make)["sum"].first()["s"] == 3 and len(calls) == 1


def record(name="r", sequence="ACGT", **how):
    n = len(sequence)
    base = {
        "name": name, "sequence": sequence, "structure": None, "data_type": "DMS", "start": 1, "end": n, "num_reads": 5, "num_aligned": 3, "skips": {"low_mapq": 2}, "num_of_mutations": [1, 2] + [0] * (n - 1),
        **{f"{c}_bases": [0.0, *[k + 1.0] * n] for k, c in enumerate(("mut", "del", "ins", "cov", "info"))}, "mod_bases": {b: [0.0, *[1.0] * n] for b in "ACGT"},
    }
    return {k: v for k, v in (base | how).items() if v is not None}


def written(tmp_path, *parts):
    paths = []
    for i, rows in enumerate(parts):
        (tmp_path / f"p{i}").mkdir(exist_ok=True)
        (tmp_path / f"p{i}" / "h.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
        paths.append(str(tmp_path / f"p{i}"))
    return paths


def test_merge_adds_up(spark, tmp_path):
    paths = written(tmp_path, [record(), record("only", "AC")], [record()], [record(structure=None)], [])
    got = merge.merge_files(spark, paths)
    assert {tuple(r) for r in got.reads.collect()} == {("r", 15, 9, 6, 0, 0, 0), ("only", 5, 3, 2, 0, 0, 0)}
    assert {(r["rname"], r["n_mut"], r["reads"]) for r in got.mutation_counts.collect()} == {("r", 0, 3), ("r", 1, 6), ("only", 0, 1), ("only", 1, 2)}
    row = got.positions.filter("rname = 'r' and pos = 4").first()
    assert (row["mut"], row["del"], row["ins"], row["cov"], row["info"], row["A"]) == (3, 6, 9, 12, 15, 3) and got.positions.count() == 6
    assert merge.merge_files(spark, paths, strict=True).positions.filter("rname = 'r' and pos = 4").first()["del"] == 2
    sinks.merged_histograms(spark, paths, str(tmp_path / "out"))
    back = files.histogram_json(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, back[0].select(*got.positions.columns).collect())) == sorted(map(tuple, got.positions.collect()))


@pytest.mark.parametrize("field,value", [("sequence", "ACGA"), ("structure", "...."), ("data_type", "SHAPE"), ("start", 2), ("end", 3)])
def test_merge_refuses(spark, tmp_path, field, value):
    paths = written(tmp_path, [record(), record("other")], [record(**{field: value})])
    with pytest.raises(Exception, match=f"parts of r can't be merged, they differ in {field}"):
        merge.merge_files(spark, paths)
    assert [tuple(r) for r in merge.merge_files(spark, paths[:1]).reads.select("rname").collect()]


def test_merge_of_other_names_short_arrays_and_nothing(spark, tmp_path):
    assert merge.merge_files(spark, written(tmp_path, [record("a")], [record("b", "GG")])).refs.count() == 2
    with pytest.raises(Exception, match="don't reach its end: r"):
        merge.merge_files(spark, written(tmp_path, [record(mut_bases=[0.0, 1.0])]))
    for paths in ([], written(tmp_path, [])):
        assert [t.count() for t in merge.merge_files(spark, paths)] == [0, 0, 0, 0]
        sinks.merged_histograms(spark, paths, str(tmp_path / f"empty{len(paths)}"))
        assert spark.read.text(str(tmp_path / f"empty{len(paths)}")).count() == 0


def test_merge_moves_records_by_reference(spark, tmp_path, monkeypatch):
    """Rows of positions aren't shuffled, only the arrays that they come from, and by reference alone."""
    plans, staged = [], merge.stage
    monkeypatch.setattr(merge, "stage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or staged(df, name))
    for strict in (False, True):
        merge.merge_files(spark, written(tmp_path, [record(), record("only", "AC")], [record()]), strict=strict)
    sums = [[x for x in p.splitlines() if "Exchange" in x] for p in plans[1::2]]
    assert len(sums) == 2 and all(len(x) == 1 and re.search(r"hashpartitioning\(rname#\d+, \d+\)", x[0]) for x in sums)


def test_gathered_counts_are_written_alike(spark, tmp_path):
    """One row for each reference gives the files that tables of positions, mutations and reads give; a reference without
    reads and one of many positions, in pieces, among them."""
    refs = spark.createDataFrame([("a", "ACGT" * 3), ("long", "ACGTA" * 500), ("none", "ACG"), ("empty", "")], "rname string, sequence string")
    rows = [("a", p, None, None, *range(9), 0) for p in (0, 1, 5, 12, 13)] + [("long", p, None, None, *[p] * 9, 0) for p in range(1, 2501, 7)] + [("a", None, 2, None, *[0] * 9, 5), ("a", None, 0, "low_mapq", *[0] * 9, 3)]
    tallied = spark.createDataFrame(rows, f"rname string, pos int, n_mut int, reason string, {', '.join(f'{c} long' for c in histogram.SUMS)}, reads long")
    sinks.histogram_json(refs, histogram.of_positions(tallied), histogram.of_mutations(tallied), histogram.of_reads(tallied), str(tmp_path / "tables"))
    sinks.gathered_histogram_json(refs, histogram.gathered(tallied), str(tmp_path / "gathered"))
    tables, gathered = (sorted(r["value"] for r in spark.read.text(str(tmp_path / n)).collect()) for n in ("tables", "gathered"))
    assert tables == gathered and len(tables) == 3
    a = json.loads(next(x for x in tables if '"name":"a"' in x))
    assert a["cov_bases"] == [0] * 13 and a["info_bases"] == [0, 1, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0, 1] and a["mod_bases"]["T"][12] == 8 and a["num_of_mutations"] == [0, 0, 5] + [0] * 10
    assert (a["num_reads"], a["num_aligned"], a["skips"]["low_mapq"]) == (8, 5, 3)
    long = json.loads(next(x for x in tables if '"name":"long"' in x))
    assert len(long["T_bases"] if "T_bases" in long else long["mod_bases"]["T"]) == 2501 and long["mut_bases"][8] == 8 and sum(long["mut_bases"]) == sum(range(1, 2501, 7))


def test_differences_of_each_kind(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "x"), (3, None, "x"), (None, 4.0, None)], "k int, v double, s string")
    b = spark.createDataFrame([(1, 1.009, "x"), (2, 2.2, "y"), (4, 1.0, "z"), (None, 4.0, None)], "k int, v double, s string")
    rows = sorted(map(tuple, reports.difference_rows(a, b, ["k"], 0.01).collect()), key=str)
    assert rows == sorted([(2, "values", "v", "2.0", "2.2"), (2, "values", "s", "x", "y"), (3, "only left", None, None, None), (4, "only right", None, None, None)], key=str)
    assert {r["difference"]: r["n"] for r in reports.differences(a, b, ["k"], 0.01).collect()} == {"values": 1, "only left": 1, "only right": 1}
    assert reports.difference_rows(a, b, ["k"]).filter("k = 1").count() == 1 and reports.difference_rows(a, a, ["k"]).count() == 0


def test_statistics_of_chunks(spark, tmp_path):
    parts = {"run_chunk1": {"alignment": {"total_reads": 10, "aligned_count": 7, "unaligned_count": 3}, "reference": "a"}, "run_chunk12": {"alignment": {"total_reads": 5, "unaligned_count": 1, "unique_alignments": 4}, "extra": [1]}, "run_chunk2": {}, "lone": {"alignment": {"total_reads": 2}}}
    for name, text in parts.items():
        (tmp_path / name / "Mapping_Files").mkdir(parents=True)
        (tmp_path / name / "Mapping_Files" / "alignment_stats.json").write_text(json.dumps(text, indent=2))
    (tmp_path / "run_chunk3" / "Mapping_Files").mkdir(parents=True)
    (tmp_path / "run_chunk3" / "Mapping_Files" / "alignment_stats.json").write_text("not json")
    got = {(r["sample_id"], r["chunk"]): r for r in files.alignment_stats(spark, str(tmp_path / "*" / "Mapping_Files" / "alignment_stats.json")).collect()}
    assert set(got) == {("run", 1), ("run", 12), ("run", 2), ("lone", None), ("run", 3)}
    assert got["run", 1]["aligned_count"] == 7 and got["run", 12]["aligned_count"] is None and got["run", 2]["total_reads"] is None and got["run", 3]["error"] == "not json"
    known = files.alignment_stats(spark, str(tmp_path / "run_*" / "Mapping_Files")).filter("error is null and total_reads is not null")
    total = reports.alignment_totals(known, "sample_id").first()
    assert (total["total_reads"], total["aligned_count"], total["chunks_processed"]) == (15, 11, 2)
    for s in "ab":
        (tmp_path / s / "BitVector_Files").mkdir(parents=True)
        (tmp_path / s / "BitVector_Files" / "summary.csv").write_text("name,num_reads\nr,3\n")
    assert {(r["sample_id"], r["num_reads"]) for r in files.summaries(spark, str(tmp_path / "*" / "BitVector_Files" / "summary.csv")).collect()} == {("a", "3"), ("b", "3")}


def test_names_of_chunk_files(spark):
    names = ["/x/s_1_chunk3_1.fastq", "/x/s_1_chunk3_2.fastq", "/x/s_1_chunk12_R1.fq.gz", "chunk_7.fastq", "/y/t_chunk_4_2.fastq", "/y/t_chunk4_2.fq", "no.fastq", "s_1_chunk3.txt"]
    named = chunks.named_files(spark.createDataFrame([(n,) for n in names], "file string"), "file")
    got = {(r["sample_id"], r["chunk"]): (r["r1"], r["r2"], r["kind"]) for r in chunks.paired_files(named, "file").collect()}
    assert got == {("s_1", 3): (names[0], names[1], "paired"), ("s_1", 12): (names[2], None, "single"), ("", 7): (names[3], None, "single"), ("t", 4): (None, names[5], "repeated")}
    lists = {(r["sample_id"], r["mate"], r["piece"]): r["files"] for r in chunks.file_lists(named, "file", 10).collect()}
    assert lists["s_1", 1, 0] == [names[0]] and lists["s_1", 1, 1] == [names[2]] and lists["t", 2, 0] == [names[5], names[4]]


def test_arrays_of_vectors_in_splits(spark, tmp_path):
    rows = [["r,1", 44, 0, 10, 0, {"3": "A"}, {}, {"5": "?"}], ['q"', 1, 2, 3, 4, {}, {"7": "1"}, {}]] * 200
    (tmp_path / "m").mkdir()
    for name, own in (("muts.json", rows), ("one.json", rows[:1]), ("none.json", [])):
        (tmp_path / "m" / name).write_text("[" + ",".join(json.dumps(r) for r in own) + "]")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        got = files.bit_vectors_json_array(spark, str(tmp_path / "m")).groupBy("rname", F.to_json("bits").alias("bits")).count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(r["rname"], r["bits"]): r["count"] for r in got} == {("r,1", '[{"pos":3,"bit":"A"},{"pos":5,"bit":"?"}]'): 201, ('q"', '[{"pos":7,"bit":"1"}]'): 200}


READ = "qname string, flag string, rname string, pos int, mapq int, rnext string, pnext int, mate int"


@pytest.mark.parametrize("cut", [1, 3, 7])
def test_mates_of_a_stream_equal_the_batch(spark, tmp_path, cut):
    def line(q, mate, pos, pnext, mapq=44, flag=None):
        return (q, flag or ("67" if mate == 1 else "131"), "r1", pos, mapq, "=", pnext, mate)

    rows = [line("a", 1, 1, 5), line("b", 1, 1, 9), line("c", 1, 2, 6), line("d", 1, 3, 7), line("a", 2, 5, 1), line("e", 2, 4, 3), line("b", 2, 5, 1), line("c", 2, 6, 2, 30), line("d", 2, 7, 3), line("d", 2, 7, 3), line("f", 1, 9, 9, flag="2115"), line("g", 1, 1, 2), line("g", 2, 2, 1), line("a", 1, 8, 5, flag="323")]
    batch = spark.createDataFrame(rows, READ)
    timed = [(*r, i // 2) for i, r in enumerate(rows)] + [(None,) * 8 + (10_000,)]
    for k in range(0, len(timed), cut):
        spark.createDataFrame(timed[k : k + cut], READ + ", at int").withColumn("seen", F.timestamp_seconds(F.col("at") + 1_000_000)).drop("at").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found = mates.fragments_of_stream(stream, 60)
    found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
    settled = spark.read.schema(found.schema).parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, vectors.pairs_of(settled).collect()), key=str) == sorted(map(tuple, vectors.consistent_pairs(batch).collect()), key=str)
    assert sorted(r["qname"] for r in vectors.orphans_of(settled).collect()) == sorted(r["qname"] for r in vectors.orphans(batch).collect()) == ["e"]


def test_a_mate_that_comes_too_late_is_alone(spark, tmp_path):
    rows = [("a", "67", "r1", 1, 44, "=", 5, 1, 0), (None,) * 8 + (500,), (None,) * 8 + (501,), ("a", "131", "r1", 5, 44, "=", 1, 2, 480), (None,) * 8 + (9000,)]
    for r in rows:
        spark.createDataFrame([r], READ + ", at int").withColumn("seen", F.timestamp_seconds(F.col("at") + 1_000_000)).drop("at").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found = mates.fragments_of_stream(stream, 60)
    found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
    settled = spark.read.schema(found.schema).parquet(str(tmp_path / "out"))
    assert vectors.pairs_of(settled).count() == 0 and vectors.orphans_of(settled).count() == 2


def test_what_a_stream_waits_for_can_be_on_disk(spark, tmp_path):
    rows = [("a", "67", "r1", 1, 44, "=", 5, 1, 0), ("a", "131", "r1", 5, 44, "=", 1, 2, 1), (None,) * 8 + (9000,)]
    for r in rows:
        spark.createDataFrame([r], READ + ", at int").withColumn("seen", F.timestamp_seconds(F.col("at") + 1_000_000)).drop("at").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    old = {k: spark.conf.get(k, None) for k in [f"spark.sql.streaming.stateStore.{x}" for x in ("providerClass", "rocksdb.boundedMemoryUsage", "rocksdb.maxMemoryUsageMB", "rocksdb.changelogCheckpointing.enabled")]}
    mates.wait_on_disk(spark)
    try:
        stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        found = mates.fragments_of_stream(stream, 60)
        found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert vectors.pairs_of(spark.read.schema(found.schema).parquet(str(tmp_path / "out"))).count() == 1
    assert list(tmp_path.glob("state/state/**/*.changelog")) or list(tmp_path.glob("state/state/**/*.zip"))


def test_streamed_mates_wait_with_what_tells_pairs(spark, tmp_path, monkeypatch):
    """Files, state and results of stream_pairs are small beside the reads that they are of."""
    from strandframe.plans import results

    monkeypatch.setattr(results, "shared_dir", lambda *a: str(tmp_path / "mates"))
    monkeypatch.setattr(results.mates, "wait_on_disk", lambda spark: None)
    assert results.stream_pairs(spark, "/root/testdata/sf0.001").groupBy("kind").count().count() == 2
    n = spark.read.parquet(str(tmp_path / "mates" / "in")).filter("qname is not null").count()
    size = {k: sum(p.stat().st_size for p in (tmp_path / "mates" / k).rglob(f"*.{end}")) / n for k, end in (("in", "parquet"), ("out", "parquet"), ("state", "delta"))}
    assert n > 10_000 and 0 < size["in"] < 30 and 0 < size["out"] < 40 and 0 < size["state"] < 60, size


def test_reads_of_a_stream_keep_their_columns(spark, tmp_path):
    """Nested columns, nulls and odd letters come out of the state as they went in."""
    kind = "qname string, mate int, seen timestamp, flag string, n long, x struct<a:int,b:array<string>>"
    rows = [("a", 1, 0, "65", 1, (1, ["é", None])), ('b"', 1, 1, "65", None, None), ("a", 2, 2, "129", 1 << 60, (None, [])), (None, None, 9000, None, None, None)]
    for k, r in enumerate(rows):
        df = spark.createDataFrame([(*r[:2], None, *r[3:])], kind).withColumn("seen", F.timestamp_seconds(F.lit(r[2] + 1_000_000)))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found = mates.fragments_of_stream(stream, 60)
    found.writeStream.format("memory").queryName("kept_columns").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    got = {r["qname"]: r for r in spark.table("kept_columns").collect()}
    assert tuple(got["a"]["r1"]) == ("a", "65", 1, (1, ["é", None])) and tuple(got["a"]["r2"]) == ("a", "129", 1 << 60, (None, []))
    assert tuple(got['b"']["r1"]) == ('b"', "65", None, None) and got['b"']["r2"] is None and (got['b"']["n1"], got['b"']["n2"]) == (1, 0)
