import gzip
import json

import pytest
from pyspark.sql import functions as F

from strandframe.model import BitVectorConfig, InputError, MissingRequirement
from strandframe.operators import chunks, filters, histogram, reads, validate, vectors
from strandframe.sinks import files as sinks
from strandframe.sources import files
from strandframe.streaming import merge

REF = "ACGTTGCAAC" * 4
SAM = f"""@HD\tVN:1.0
@SQ\tSN:r1\tLN:40
q1\t0\tr1\t1\t44\t40M\t*\t0\t0\t{REF}\t{'I' * 40}\tAS:i:0\tMD:Z:40
q2\t4\t*\t0\t0\t*\t*\t0\t0\tACGT\tIIII

q3\t0\tr1\t3\t44\t10M\t*\t0\t0\tCTTTGCAACA\t{'I' * 10}
"""


@pytest.fixture()
def sam(tmp_path):
    (tmp_path / "a.sam").write_text(SAM)
    (tmp_path / "refs.fasta").write_text(f">r1 first\n{REF[:20]}\n{REF[20:]}\n>r2\nACGT\n>r2\nACGG\n")
    return tmp_path


def test_fasta(spark, sam):
    got = {r["rname"]: r["sequence"] for r in files.fasta(spark, str(sam / "refs.fasta"), first_token=True).collect()}
    assert got == {"r1": REF, "r2": "ACGG"}
    assert "r1 first" in {r["rname"] for r in files.fasta(spark, str(sam / "refs.fasta")).collect()}


def test_sam(spark, sam):
    rows = {r["qname"]: r for r in files.sam(spark, str(sam / "a.sam"), mapped_only=True).collect()}
    assert set(rows) == {"q1", "q3"} and rows["q1"]["md_string"] == "40" and rows["q3"]["md_string"] == "" and rows["q1"]["pos"] == 1
    (sam / "bad.sam").write_text("q\t0\tr\tx\n")
    assert files.sam(spark, str(sam / "bad.sam"), strict=False).count() == 0
    with pytest.raises(Exception, match="not an aligned read"):
        files.sam(spark, str(sam / "bad.sam")).collect()


def test_fastq_and_chunks(spark, tmp_path):
    text = "".join(f"@q{i}\n{'ACGT' * 3}\n+\n{'I' * 10 + '#' * 2}\n" for i in range(25))
    (tmp_path / "a.fastq").write_text(text)
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as f:
        f.write(text)
    for name in ("a.fastq", "b.fastq.gz"):
        got = files.fastq(spark, str(tmp_path / name)).orderBy("number").collect()
        assert [r["qname"] for r in got] == [f"q{i}" for i in range(25)] and got[3]["seq"] == "ACGT" * 3
    one = files.fastq(spark, str(tmp_path / "a.fastq"))
    assert reads.quality_trim(one, 20, 5).first()["seq"] == "ACGTACGTAC"
    assert validate.fastq_violations(spark, str(tmp_path / "a.fastq")).count() == 0
    numbered = chunks.numbered(one, "number").withColumn("chunk", F.floor(F.col("row") / 10))
    sinks.fastq_chunks(numbered, str(tmp_path / "out"))
    again = files.fastq(spark, str(tmp_path / "out" / "chunk=1"))
    assert sorted(r["qname"] for r in again.collect()) == [f"q{i}" for i in range(10, 20)]


def test_samples(spark, tmp_path):
    (tmp_path / "s.csv").write_text("sample_id,fasta,fastq1,fastq2,dot_bracket\n,/x/lib.fasta,a.fq,,\ns2,y.fa,b.fq,c.fq,d.csv\n")
    got = files.samples(spark, str(tmp_path / "s.csv")).collect()
    assert [(r["sample_id"], r["fastq2"]) for r in got] == [("sample_lib", None), ("s2", "c.fq")]


def test_whole_run_and_sinks(spark, sam, tmp_path):
    refs = files.fasta(spark, str(sam / "refs.fasta"), first_token=True)
    judged = filters.with_reason(vectors.single_fragments(files.sam(spark, str(sam / "a.sam"), mapped_only=True), refs))
    sinks.bit_vectors(judged, str(tmp_path / "text"), BitVectorConfig())
    back = {r["qname"]: r for r in files.bit_vector_text(spark, str(tmp_path / "text" / "*" / "*")).collect()}
    assert set(back) == {"q1", "q3"} and len(back["q1"]["bits"]) == 40 and back["q3"]["n_letters"] == 7
    sinks.bit_vectors(judged, str(tmp_path / "json"), BitVectorConfig(storage_format="json"))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "json")).collect()]
    assert sorted(x[0] for x in lines) == ["r1", "r1"] and any(x[5] for x in lines)
    sinks.bit_vectors(judged, str(tmp_path / "none"), BitVectorConfig(summary_output_only=True))
    assert not (tmp_path / "none").exists()
    pos, nmut, counts = histogram.positions(judged), histogram.mutation_counts(judged), histogram.read_counts(judged)
    shapes = spark.createDataFrame([("r1", "ACGT", "....")], "name string, sequence string, structure string")
    sinks.histogram_json(refs, pos, nmut, counts, str(tmp_path / "histo"), structures=shapes)
    record = {json.loads(r["value"])["name"]: json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "histo")).collect()}
    assert len(record["r1"]["mut_bases"]) == 41 and sum(record["r1"]["num_of_mutations"]) == 2 and record["r2"]["num_reads"] == 0
    assert record["r1"]["structure"] == "...." and "structure" not in record["r2"]
    sinks.histogram_json_object(spark, str(tmp_path / "histo"), str(tmp_path / "object"))
    assert set(json.loads("\n".join(r["value"] for r in spark.read.text(str(tmp_path / "object"), wholetext=True).collect()))) == {"r1", "r2"}
    for path, form in (("histo", "lines"), ("object", "object")):
        pos2, nmut2, counts2 = files.histogram_json(spark, str(tmp_path / path), form)
        assert sorted(map(tuple, pos2.collect())) == sorted(map(tuple, pos.select(*pos2.columns).collect()))
        assert sorted(map(tuple, nmut2.collect())) == sorted(map(tuple, nmut.collect())) and counts2.count() == 2
    vectors_ = {r["rname"]: r for r in files.bit_vectors_json(spark, str(tmp_path / "json")).collect()}
    assert vectors_["r1"]["mapqs"] == [44, 0] and all(b["bit"] in "ACGT1?" for b in vectors_["r1"]["bits"])
    sinks.joined_bit_vectors(spark, [str(tmp_path / "text" / "*" / "*")], str(tmp_path / "joined"))
    again = {r["qname"]: r for r in files.bit_vector_text(spark, str(tmp_path / "joined" / "*" / "*")).collect()}
    assert {q: (r["rname"], r["bits"]) for q, r in again.items()} == {q: (r["rname"], r["bits"]) for q, r in back.items()}


def test_pairs_by_place_and_by_name(spark, tmp_path):
    def line(q, flag, pos, pnext, mapq=44, rname="r1"):
        return f"{q}\t{flag}\t{rname}\t{pos}\t{mapq}\t4M\t=\t{pnext}\t0\tACGT\tIIII"

    rows = [line("a", 67, 1, 5), line("a", 131, 5, 1), line("b", 67, 1, 9), line("b", 131, 5, 1), line("c", 67, 2, 6), line("c", 131, 6, 2, 30), line("d", 67, 2, 6), line("d", 131, 6, 2), line("a", 2115, 7, 5), line("e", 67, 3, 4)]
    (tmp_path / "p.sam").write_text("@HD\tVN:1.0\n@SQ\tSN:r1\tLN:40\n" + "\n".join(rows) + "\n\n" + line("f", 67, 1, 5) + "\n" + line("f", 131, 5, 1) + "\n")
    reads_ = files.numbered_sam(spark, str(tmp_path / "p.sam"))
    assert reads_.count() == 10 and files.numbered_sam(spark, str(tmp_path / "p.sam"), stop_at_blank=False).count() == 12
    assert {r["qname"] for r in vectors.positional_pairs(reads_).collect()} == {"a", "d"}
    named = files.with_mate(files.sam(spark, str(tmp_path / "p.sam")))
    assert {r["qname"] for r in vectors.consistent_pairs(named).collect()} == {"a", "d", "f"} and [r["qname"] for r in vectors.orphans(named).collect()] == ["e"]


def test_unknown_references_are_errors(spark):
    reads_ = spark.createDataFrame([("q", "zz", 1, 44, "4M", "ACGT", "IIII")], "qname string, rname string, pos int, mapq int, cigar string, seq string, qual string")
    refs = spark.createDataFrame([("r1", "ACGTACGT")], "rname string, sequence string")
    with pytest.raises(Exception, match="unknown reference: zz"):
        vectors.single_fragments(reads_, refs).collect()


def test_inputs_are_validated_by_one_call(spark, tmp_path):
    (tmp_path / "r.fasta").write_text(">a\nACGT\n>b\nACGG\n")
    (tmp_path / "q.fastq").write_text("@q\nACGT\n+\nIIII\n")
    (tmp_path / "s.csv").write_text("name,sequence,structure\na,ACGT,....\nb,ACGG,....\n")
    good = [str(tmp_path / n) for n in ("r.fasta", "q.fastq")]
    assert validate.validate_inputs(spark, *good, structures=str(tmp_path / "s.csv")) == [] and validate.fasta_warnings(spark, good[0], 1)
    with pytest.raises(MissingRequirement):
        validate.validate_inputs(spark, good[0], None)
    for name, text, message in (("q.fastq", "q\nACGT\n+\nIIII\n", "start with @"), ("q.fastq", "@q\nACGT\nx\nIIII\n", "third line"), ("s.csv", "name,sequence,structure\na,ACGT,....\n", "1 rows for 2"), ("s.csv", "name,sequence\na,ACGT\n", "no such column")):
        (tmp_path / "bad").mkdir(exist_ok=True)
        (tmp_path / "bad" / name).write_text(text)
        with pytest.raises(InputError, match=message):
            validate.validate_inputs(spark, good[0], str(tmp_path / "bad" / name) if name == "q.fastq" else good[1], structures=str(tmp_path / "bad" / name) if name == "s.csv" else None)


@pytest.mark.parametrize("text,message", [(">a\n\nACGT", "blank"), ("ACGT\n>a", "name line"), ("> a\nACGT", "space"), (">a\nACGU", "only A, C, G and T"), (">a\n>b", "may not start")])
def test_bad_fasta(spark, tmp_path, text, message):
    (tmp_path / "x.fasta").write_text(text + "\n")
    with pytest.raises(InputError, match=message):
        validate.require(validate.fasta_violations(spark, str(tmp_path / "x.fasta")), "x.fasta")


def test_structures_and_params(spark):
    refs = spark.createDataFrame([("a", "A"), ("b", "C")], "rname string, sequence string")
    s = spark.createDataFrame([("a", "A", "."), ("z", "A", ".")], "name string, sequence string, structure string")
    assert {(r["name"], r["message"]) for r in validate.structure_violations(refs, s).collect()} == {("b", "no structure"), ("z", "no such reference")}
    schema = {"map": {"threads": int}, "bit_vector": {"cutoff": int, "percent": float}}
    assert validate.check_params({"map": {"threads": 2}}, schema) == []
    assert len(validate.check_params({"map": {"nope": 2}, "bit_vector": {"cutoff": "x"}, "other": 1}, schema)) == 3


def test_stream_equals_batch(spark, sam, tmp_path):
    refs = files.fasta(spark, str(sam / "refs.fasta"), first_token=True)
    source = files.sam(spark, str(sam / "a.sam"), mapped_only=True)
    source.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    merge.count_stream(stream, refs, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    want = histogram.positions(filters.with_reason(vectors.single_fragments(source, refs)))
    judged = filters.with_reason(vectors.single_fragments(source, refs))
    for got, right in zip(merge.merged(spark, str(tmp_path / "out")), (want, histogram.mutation_counts(judged), histogram.read_counts(judged)), strict=True):
        assert sorted(map(tuple, got.select(*right.columns).collect())) == sorted(map(tuple, right.collect()))


def test_many_references_have_their_header_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "HEADER", 3)
    refs = spark.createDataFrame([(f"r{i}", REF) for i in range(9)], "rname string, sequence string")
    cells = "qname string, flag string, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string, md_string string, mate int"
    rows = [(f"q{i}", "67" if m == 1 else "131", f"r{i % 9}", 1 + 4 * (m - 1), 44, "4M", "=", 5 - 4 * (m - 1), 0, "ACGT", "IIII", "", m) for i in range(40) for m in (1, 2)]
    sinks.sam(spark.createDataFrame(rows, cells).repartition(4), refs, str(tmp_path / "sam"), "qname", "mate")
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "sam")).collect()]
    assert sum(x.startswith("@SQ") for x in lines) == 9 and lines.count("@HD\tVN:1.0") == 1
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in (("spark.sql.files.maxPartitionBytes", "300"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
            spark.conf.set(k, v)
        pairs = vectors.positional_pairs(files.numbered_sam(spark, str(tmp_path / "sam")))
        assert "SortMergeJoin" not in pairs._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["qname"] for r in pairs.collect()) == sorted(f"q{i}" for i in range(40))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_many_references_share_files_of_vectors(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FOLDERS", 3)
    refs = spark.createDataFrame([(f"r{i}", REF[i:] + REF[:i]) for i in range(9)], "rname string, sequence string")
    rows = [(f"q{i}", f"r{i % 9 if i < 60 else 0}", 1 + i % 5, 44, "12M", REF[:12], "I" * 12) for i in range(200)]
    judged = filters.with_reason(vectors.single_fragments(spark.createDataFrame(rows, "qname string, rname string, pos int, mapq int, cigar string, seq string, qual string"), refs))
    sinks.bit_vectors_text(judged, str(tmp_path / "text"), rows=50)
    sinks.joined_bit_vectors(spark, [str(tmp_path / "text" / "*" / "*")], str(tmp_path / "joined"))
    made = list((tmp_path / "text").glob("*/*/*.txt"))
    assert len({p.parent.parent for p in made}) <= 4 and len({p.parent for p in made}) < 9
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = {r["qname"]: (r["rname"], r["sequence"], r["bits"]) for r in judged.collect()}
    for size in ("500", old):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            for folder in ("text", "joined"):
                got = files.bit_vector_text(spark, str(tmp_path / folder / "*" / "*")).collect()
                assert len(got) == 200 and {r["qname"]: (r["rname"], r["sequence"], r["bits"]) for r in got} == want
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_stream_of_many_files_has_few_batches(spark, monkeypatch):
    from strandframe.plans import catalogue, synth
    from strandframe.streaming import merge

    folders = []
    monkeypatch.setattr(catalogue, "BATCHES", 2)
    monkeypatch.setattr(merge, "merged", lambda _, folder: folders.append(folder))
    gathered = synth.reads(spark, "/root/testdata/sf0.001", gathered=True)
    assert gathered.select("rname", F.spark_partition_id()).distinct().count() == gathered.select("rname").distinct().count()
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(before, ("12", "false")):
            spark.conf.set(k, v)
        catalogue._streamed(spark, "/root/testdata/sf0.001")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert spark.read.parquet(folders[0]).select("batch").distinct().count() == 2


def test_files_of_a_folder_are_one(spark, tmp_path):
    reads = spark.range(40).select((F.col("id") % 2).alias("part"), "id", F.concat(F.when(F.col("id").isin(33, 35, 6), "#").otherwise("@"), F.col("id").cast("string"), F.lit("\nAC\n+\nII")).alias("value"))
    reads.repartitionByRange(5, "part", "id").sortWithinPartitions("part", "id").select("value", "part").write.partitionBy("part").text(str(tmp_path / "fastq"))
    for conf in ("128m", "24"):  # records lie across splits
        spark.conf.set("spark.sql.files.maxPartitionBytes", conf)
        found = validate.fastq_violations(spark, str(tmp_path / "fastq" / "*"), by_folder=True)
        assert sorted((r["file"][-1], r["number"]) for r in found.collect()) == [("0", 3), ("1", 16), ("1", 17)]
        assert [(r["file"][-1], r["number"]) for r in validate.first_violations(found, "file").orderBy("file").collect()] == [("0", 3), ("1", 16)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")


def test_first_violations_reads_pieces(spark):
    from strandframe.plans import results

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = results.first_violations(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks.inputFiles()) > results.PARTS


def test_json_vectors_are_parsed_once_and_arrays_not_counted(spark, tmp_path):
    lines = ['["r", 40, 0, 4, 0, {"2": "A", "10": "C"}, {"3": "1"}, {}]', '["s", null, 1, 2, 3, {}, {}, {"1": "?"}]', "{ broken", "[]", '["t", 1]']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / "lines"))
    got = [(r["rname"], r["mapqs"], r["lengths"], [tuple(b) for b in r["bits"]]) for r in files.bit_vectors_json(spark, str(tmp_path / "lines")).collect()]
    none = [None, None]
    assert got == [("r", [40, 0], [4, 0], [(2, "A"), (3, "1"), (10, "C")]), ("s", [None, 1], [2, 3], [(1, "?")]), (None, none, none, []), (None, none, none, []), ("t", [1, None], none, [])]
    plan = files.bit_vectors_json(spark, str(tmp_path / "lines"))._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "jsontostructs" not in plan.lower()
    kind = "qname string, rname string, mapqs array<int>, lengths array<int>, bits array<struct<pos:int,bit:string>>, reason string"
    judged = spark.createDataFrame([(f"q{i}", "r", [40], [2], [(1, "A")], None) for i in range(25)], kind).coalesce(1)
    sinks.bit_vectors_json_array(judged, str(tmp_path / "array"), 10)
    assert sorted(len(json.loads(r["value"])) for r in spark.read.text(str(tmp_path / "array"), wholetext=True).collect()) == [5, 10, 10]
    assert files.bit_vectors_json_array(spark, str(tmp_path / "array")).filter("rname = 'r' and bits[0].bit = 'A'").count() == 25
