"""Queries on results and files of many runs (reuse, merge, comparison, scans, lists, checks of inputs), and DuckDB SQL that
must agree."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.functions import texts
from strandframe.model import BitVectorConfig
from strandframe.operators import chunks, filters, histogram, merge, reports, reuse, trials, validate, vectors
from strandframe.plans import synth
from strandframe.plans.oracle import BASE, sql
from strandframe.plans.oracle import ORACLE as KNOWN
from strandframe.session import shared_dir, stage
from strandframe.sinks import files as sinks
from strandframe.sources import files
from strandframe.streaming import mates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PARTS = 4
#: Reads of a file that one task writes.
READS_A_FILE = 1_000_000


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return filters.with_reason(vectors.single_fragments(synth.reads(spark, d), synth.references(spark, d)))


def _packed(spark: SparkSession, d: str) -> DataFrame:
    """_judged() with vectors as text."""
    return filters.with_reason(vectors.single_fragments(synth.reads(spark, d), synth.references(spark, d), packed=True))


def _part() -> Column:
    return F.pmod(F.split("qname", ":")[0].cast("long"), F.lit(PARTS))


def _part_files(spark: SparkSession, d: str, change: Callable[[DataFrame, int], DataFrame] = lambda refs, i: refs) -> list[str]:
    """Histograms of the reads' parts by order, written as files of their own. change: what is different in a part's
    references."""
    folder = shared_dir(spark, "part-histograms")
    parts = stage(histogram.gathered(histogram.tallies(_packed(spark, d).withColumn("part", _part()), "part"), "part"), "gathered")
    for i in range(PARTS):
        sinks.gathered_histogram_json(change(synth.references(spark, d), i), parts.filter(F.col("part") == i).drop("part"), f"{folder}/{i}", structures=synth.structures(spark, d))
    return [f"{folder}/{i}" for i in range(PARTS)]


@query
def reused_summary(spark, d):
    """The summary off counts that are stored at the first call and taken from there at the second."""
    store = reuse.ResultStore(spark, shared_dir(spark, "results"))
    inputs = [f"{d}/lineitem.parquet", f"{d}/part.parquet"]
    for _ in range(2):
        tables = store.reuse("tallies", inputs, {"qscore_cutoff": 25}, lambda: {"tallies": histogram.tallies(_judged(spark, d))})
    t = tables["tallies"]
    return histogram.summary(synth.references(spark, d), histogram.of_positions(t), histogram.of_mutations(t), histogram.of_reads(t))


@query
def merge_files(spark, d):
    return merge.merge_files(spark, _part_files(spark, d)).positions


@query
def merge_files_strict(spark, d):
    """As merge_files, but with the deletions of a reference's first file only."""
    return merge.merge_files(spark, _part_files(spark, d), strict=True).positions.select("rname", "pos", "cov", "info", "mut", "del")


@query
def merged_histograms(spark, d):
    """Histograms of parts merged into files, and those read back: reads and mutations of each reference."""
    folder = shared_dir(spark, "merged")
    sinks.merged_histograms(spark, _part_files(spark, d), folder)
    _, counts, reads = files.histogram_json(spark, folder)
    mutations = counts.groupBy("rname").agg(F.sum(F.col("n_mut") * F.col("reads")).alias("mutations"))
    return reads.join(mutations, "rname", "left").select("rname", "num_reads", "num_aligned", F.coalesce("mutations", F.lit(0)).cast("long").alias("mutations"))


@query
def merge_refused(spark, d):
    """What histograms of parts disagree on, where the references of two parts were changed."""
    number = F.regexp_extract("rname", r"(\d+)$", 1).cast("long")

    def change(refs: DataFrame, part: int) -> DataFrame:
        kind = F.when((number % 10 == 0) & (part == 1), "SHAPE").otherwise("DMS")
        sequence = F.when((number % 15 == 0) & (part == 2), F.reverse("sequence")).otherwise(F.col("sequence"))
        return refs.select("rname", sequence.alias("sequence"), kind.alias("data_type"))

    return histogram.merge_conflicts([files.histogram_records(spark, _part_files(spark, d, change), fields=("name", *merge.GUARDS))], merge.GUARDS)


def _two_results(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders' prices, and the same with rows left out on both sides and prices changed a little and a lot."""
    orders = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("k"), "o_totalprice", "o_orderstatus")
    changed = F.when(F.col("k") % 11 == 0, F.col("o_totalprice") + 0.005).when(F.col("k") % 13 == 0, F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice"))
    status = F.when(F.col("k") % 17 == 0, "X").otherwise(F.col("o_orderstatus"))
    return orders.filter("k % 7 <> 0"), orders.filter("k % 5 <> 0").select("k", changed.alias("o_totalprice"), status.alias("o_orderstatus"))


@query
def result_differences(spark, d):
    return reports.differences(*_two_results(spark, d), ["k"], 0.01)


@query
def difference_rows(spark, d):
    return reports.difference_rows(*_two_results(spark, d), ["k"], 0.01).select("k", "difference", "column", F.round(F.col("left_value").try_cast("double"), 2).alias("left_number"), F.round(F.col("right_value").try_cast("double"), 2).alias("right_number"))


def _chunk_files(spark: SparkSession, d: str) -> DataFrame:
    """Names of FASTQ files of orders' lines: samples by supplier, a chunk for each order."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    mate = F.when(F.col("l_linenumber") % 4 == 0, "").otherwise(F.concat(F.lit("_"), (F.col("l_linenumber") % 2 + 1).cast("string")))
    return lines.select(F.concat(F.lit("/runs/s"), (F.col("l_suppkey") % 20).cast("string"), F.lit("_chunk"), F.col("l_orderkey").cast("string"), mate, F.lit(".fastq.gz")).alias("file")).distinct()


@query
def chunk_file_pairs(spark, d):
    return chunks.paired_files(chunks.named_files(_chunk_files(spark, d), "file"), "file")


@query
def chunk_file_lists(spark, d):
    lists = chunks.file_lists(chunks.named_files(_chunk_files(spark, d), "file"), "file", 1000)
    return lists.select("sample_id", "mate", "piece", F.array_join("files", ",").alias("files"))


def _stats_files(spark: SparkSession, d: str) -> str:
    """Alignment statistics of chunks of orders, a JSON file for each chunk; some lack fields, or have others."""
    orders = spark.read.parquet(f"{d}/orders.parquet").select((F.col("o_custkey") % 12).alias("s"), (F.col("o_orderkey") % 5).alias("c"), F.col("o_orderkey"), F.col("o_custkey"))
    sums = orders.groupBy("s", "c").agg(F.sum("o_orderkey").alias("total"), F.sum("o_custkey").alias("un"), F.count("*").alias("uniq"))
    nested = F.struct(F.col("total").alias("total_reads"), F.when(F.col("c") != 1, F.col("total") - F.col("un")).alias("aligned_count"), F.col("un").alias("unaligned_count"), F.when(F.col("c") != 2, F.col("uniq")).alias("unique_alignments"))
    text = F.to_json(F.struct(F.concat(F.lit("ref"), F.col("s").cast("string")).alias("reference"), (F.col("s") % 2 == 0).alias("is_paired_end"), F.lit("x").alias("unknown_field"), nested.alias("alignment")))
    value = F.when((F.col("s") == 3) & (F.col("c") == 3), "{ not an object").otherwise(F.replace(text, F.lit(","), F.lit(",\n  ")))
    folder = shared_dir(spark, "stats")
    out = sums.select(value.alias("value"), F.concat(F.lit("s"), F.col("s").cast("string"), F.lit("_chunk"), F.col("c").cast("string")).alias("chunk_id"))
    out.repartition("chunk_id").write.partitionBy("chunk_id").text(folder)
    return folder


@query
def stats_scan(spark, d):
    found = files.alignment_stats(spark, f"{_stats_files(spark, d)}/*/*")
    return found.select("sample_id", "chunk", "reference", "is_paired_end", "total_reads", "aligned_count", "unaligned_count", "unique_alignments", F.col("error").isNotNull().alias("broken"))


@query
def stats_report(spark, d):
    """Totals of each sample over the statistics of its chunks, as files."""
    found = files.alignment_stats(spark, f"{_stats_files(spark, d)}/*/*")
    return reports.alignment_totals(found.filter("error is null"), "sample_id").select("sample_id", "total_reads", "aligned_count", "unaligned_count", "unique_alignments", "overall_alignment_rate", "unique_percent", "chunks_processed")


@query
def fasta_faults(spark, d):
    """Faults of a FASTA file that some references were written wrongly to, counted by kind."""
    n = F.regexp_extract("rname", r"(\d+)$", 1).cast("long")
    name = F.when(n % 11 == 0, F.concat(F.lit("> "), "rname")).when(n % 13 == 0, F.col("rname")).otherwise(F.concat(F.lit(">"), "rname"))
    body = F.when(n % 17 == 0, F.concat("sequence", F.lit("U"))).when(n % 19 == 0, "  ").when(n % 23 == 0, F.concat(F.lit(">"), "sequence")).otherwise(F.col("sequence"))
    folder = shared_dir(spark, "fasta")
    synth.references(spark, d).select(F.concat(name, F.lit("\n"), body).alias("value")).write.text(folder)
    return validate.fasta_violations(spark, folder).groupBy("message").agg(F.count("*").alias("n"))


@query
def fastq_faults(spark, d):
    """Faults of FASTQ files that some reads were written wrongly to, counted by kind."""
    n = F.split("qname", ":")[0].cast("long")
    head = F.concat(F.when(n % 11 == 0, "#").otherwise("@"), F.col("qname"))
    plus = F.when(n % 13 == 0, "-").otherwise("+")
    qual = F.when(n % 17 == 0, F.concat("qual", F.lit("I"))).otherwise(F.col("qual"))
    folder = shared_dir(spark, "fastq")
    synth.reads(spark, d).select(F.concat_ws("\n", head, "seq", plus, qual).alias("value")).write.text(folder)
    return validate.fastq_violations(spark, folder).groupBy("message").agg(F.count("*").alias("n"))


@query
def structure_faults(spark, d):
    """Faults of a table of structures, written as CSV and read back: the references of odd numbers have none."""
    folder = shared_dir(spark, "structures")
    known = synth.structures(spark, d)
    n = F.regexp_extract("name", r"(\d+)$", 1).cast("long")
    again, strange = known.filter(n % 30 == 0), known.filter(n % 50 == 0).withColumn("name", F.concat(F.lit("no_"), "name"))
    sinks.csv(known.unionByName(again).unionByName(strange), folder)
    return validate.structure_violations(synth.references(spark, d), files.structures(spark, folder))


@query
def structures_scan(spark, d):
    folder = shared_dir(spark, "structures")
    sinks.csv(synth.structures(spark, d).withColumn("note", F.lit('a "quoted", cell')), folder)
    return files.structures(spark, folder)


@query
def samples_scan(spark, d):
    """A sample sheet of customers, written as CSV and read back: some without an id, or a second file."""
    c = F.col("c_custkey").cast("string")
    sheet = spark.read.parquet(f"{d}/customer.parquet").select(
        F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("s"), c)).otherwise("").alias("sample_id"), F.concat(F.lit("/lib/r"), c, F.lit(".fasta")).alias("fasta"), F.concat(c, F.lit("_1.fq")).alias("fastq1"),
        F.when(F.col("c_custkey") % 2 == 0, F.concat(c, F.lit("_2.fq"))).otherwise(" ").alias("fastq2"), F.lit("").alias("dot_bracket"),
    )
    folder = shared_dir(spark, "samples")
    sinks.csv(sheet, folder)
    return files.samples(spark, folder)


@query
def trials_scan(spark, d):
    """The trials of a search, written as CSV and read back: the commonest value of each parameter of the best."""
    orders = spark.read.parquet(f"{d}/orders.parquet")
    searched = orders.select(F.col("o_orderkey").alias("trial"), F.col("o_totalprice").alias("quality_score"), F.col("o_orderstatus").alias("p_status"), F.col("o_orderpriority").alias("p_priority"), (F.col("o_custkey") % 7).cast("string").alias("p_cust"))
    folder = shared_dir(spark, "trials")
    sinks.csv(searched, folder)
    return trials.modes(trials.frequency(trials.long(trials.top(files.trials(spark, folder), 100))))


@query
def mapped_reads(spark, d):
    """Single reads written as SAM, every fifth order unmapped, with MD tags: the mapped ones."""
    unmapped = F.split("key", ":")[0].cast("long") % 5 == 0
    reads = synth.reads(spark, d).withColumn("flag", F.when(unmapped, "4").otherwise("0")).withColumn("md_string", F.when(F.col("pos") % 2 == 0, F.col("cigar")).otherwise(""))
    folder = shared_dir(spark, "sam")
    sinks.sam(reads, synth.references(spark, d), folder)
    found = files.sam(spark, folder, mapped_only=True)
    return found.select("qname", "flag", "pos", "md_string", F.lit(files.is_paired(found)).alias("paired"))


@query
def sam_mode_bits(spark, d):
    """Vectors by all letters of CIGARs: = as a match, N as a deletion."""
    fragments = vectors.single_fragments(synth.reads(spark, d), synth.references(spark, d), BitVectorConfig(cigar_mode="sam"))
    return fragments.filter(F.col("qname").isNotNull()).select("qname", F.inline("bits")).groupBy("qname").agg(F.count("*").alias("symbols"), F.sum(F.when(F.col("bit") == "0", F.col("pos")).otherwise(0)).alias("matched"), F.sum(F.when(F.col("bit").isin("1", "?"), F.col("pos")).otherwise(0)).alias("gone"))


@query
def json_array_roundtrip(spark, d):
    """Accepted vectors as JSON arrays and back, counted by symbol."""
    folder = shared_dir(spark, "json")
    sinks.bit_vectors_json_array(_judged(spark, d), folder, 500)
    each = files.bit_vectors_json_array(spark, folder).select("rname", F.inline("bits"))
    return each.groupBy("rname", "pos", "bit").agg(F.count("*").alias("n"))


@query
def stream_pairs(spark, d):
    """The reads as a stream of files that part mates, without the second mates of every seventh order: pairs and orphans,
    counted by reference. Files and stream have the columns that tell pairs and orphans."""
    gone = (F.col("mate") == 2) & (F.split("key", ":")[0].cast("long") % 7 == 0)
    folder, start = shared_dir(spark, "mates"), F.lit("2000-01-01 00:00:00").cast("timestamp")
    reads = synth.mates(spark, d).filter(~gone).select("qname", "flag", "rname", "pos", "mapq", "rnext", "pnext", "mate").withColumn("seen", start)
    for half in range(2):  # each mate is in either half of the files, which aren't shuffled for that
        reads.filter(F.pmod(F.xxhash64("qname", "mate"), F.lit(2)) == half).write.mode("append").parquet(f"{folder}/in", compression="zstd")
        written = spark.read.schema(reads.schema).parquet(f"{folder}/in")
        first = len(written.inputFiles()) if half == 0 else first
    waiting = written.count() // 2  # all names wait for the last row
    reads.limit(0).drop("seen").join(spark.range(1).select((start + F.expr("interval 1 day")).alias("seen")), how="right").select(*reads.columns).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(reads.schema).option("maxFilesPerTrigger", max(1, first)).parquet(f"{folder}/in")
    mates.wait_on_disk(spark)
    found = mates.fragments_of_stream(stream, 60, buckets=max(1024, waiting // 1000))
    found = found.withColumns({r: F.col(r).dropFields("qname", "flag") for r in ("r1", "r2")})
    found.writeStream.format("parquet").option("compression", "zstd").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/out").trigger(availableNow=True).start().awaitTermination()
    settled = spark.read.schema(found.schema).parquet(f"{folder}/out")
    both = vectors.pairs_of(settled).select("rname", F.lit("pair").alias("kind")).unionByName(vectors.orphans_of(settled).select("rname", F.lit("orphan").alias("kind")))
    return both.groupBy("rname", "kind").agg(F.count("*").alias("n"))


@query
def joined_vectors(spark, d):
    """Accepted vectors of two chunks as text files, joined into files by reference, and read back."""
    folder = shared_dir(spark, "vectors")
    judged = _packed(spark, d)
    for i in range(2):
        sinks.bit_vectors_text(judged.filter(F.pmod(_part(), F.lit(2)) == i), f"{folder}/{i}")
    sinks.joined_bit_vectors(spark, [f"{folder}/{i}/*/*" for i in range(2)], f"{folder}/all")
    return texts.symbols(files.bit_vector_text(spark, f"{folder}/all/*/*", packed=True), "qname", "rname")


@query
def storage_formats(spark, d):
    """Accepted vectors in each configured format: how many each has, and their mutations."""
    folder, judged = shared_dir(spark, "formats"), _judged(spark, d)
    for kind in ("text", "json"):
        sinks.bit_vectors(judged, f"{folder}/{kind}", BitVectorConfig(storage_format=kind))
    found = {"text": files.bit_vector_text(spark, f"{folder}/text/*/*"), "json": files.bit_vectors_json(spark, f"{folder}/json")}
    mutations = F.size(filters.mutation_positions(F.col("bits")))
    text, json_ = (df.agg(F.count("*").alias("vectors"), F.sum(mutations).alias("mutations")).select(F.lit(kind).alias("format"), "*") for kind, df in found.items())
    return text.unionByName(json_)


@query
def blank_line_stop(spark, d):
    """SAM files of which each has a blank line in the middle: what stands before it."""
    cells = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
    each = max(1, math.ceil(spark.read.parquet(f"{d}/lineitem.parquet").count() / (PARTS * READS_A_FILE)))  # files of a part
    file = (_part() * each + F.pmod(F.xxhash64("qname"), F.lit(each))).alias("part")
    reads = synth.reads(spark, d).select(F.concat_ws("\t", *[F.col(c).cast("string") for c in cells]).alias("value"), file, F.when(F.col("mapq") % 3 == 0, 0).otherwise(2).alias("rank"))
    blank = reads.select("part").distinct().select(F.lit(" ").alias("value"), "part", F.lit(1).alias("rank"))
    header = reads.select("part").distinct().select(F.lit("@HD\tVN:1.0").alias("value"), "part", F.lit(-1).alias("rank"))
    folder = shared_dir(spark, "sam")
    reads.unionByName(blank).unionByName(header).repartition("part").sortWithinPartitions("part", "rank").select("value", "part").write.partitionBy("part").text(folder)
    return files.numbered_sam(spark, f"{folder}/*").select("qname", "rname", "mapq")


@query
def first_violations(spark, d):
    """FASTQ files of reads by name, some faulty, in pieces: the first fault of each file."""
    n = F.split("qname", ":")[0].cast("long")
    text = F.concat_ws("\n", F.concat(F.when(n % 101 == 0, "#").otherwise("@"), F.col("qname")), "seq", F.when(n % 103 == 0, "-").otherwise("+"), "qual")
    folder = shared_dir(spark, "fastq")
    reads = synth.reads(spark, d).select("qname", text.alias("value"), _part().alias("part"))
    reads.repartitionByRange("part", "qname").sortWithinPartitions("part", "qname").select("value", "part").write.partitionBy("part").text(folder)
    found = validate.first_violations(validate.fastq_violations(spark, f"{folder}/*", by_folder=True), "file")
    return found.select(F.regexp_extract("file", "part=([0-9]+)", 1).cast("long").alias("part"), "number", "message")


@query
def totals_files(spark, d):
    """Totals of alignment by sample, written as JSON and read back."""
    folder = shared_dir(spark, "totals")
    stats = spark.read.parquet(f"{d}/orders.parquet").select((F.col("o_custkey") % 50).alias("sample_id"), F.col("o_orderkey").alias("total_reads"), F.lit(None).cast("long").alias("aligned_count"), (F.col("o_custkey") % 10).alias("unaligned_count"))
    sinks.report_json(reports.alignment_totals(stats, "sample_id"), folder)
    return spark.read.json(folder).select("sample_id", "total_reads", "aligned_count", "unaligned_count", "overall_alignment_rate", "chunks_processed")


@query
def summaries_scan(spark, d):
    """Summary CSV files of four samples, read back by one glob: rows and reads of each."""
    folder = shared_dir(spark, "summaries")
    orders = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("name"), F.when(F.col("o_orderkey") % 7 == 0, "NA").otherwise(F.col("o_custkey").cast("string")).alias("num_reads"))
    for i in range(4):
        sinks.csv(orders.filter(F.col("name") % 4 == i), f"{folder}/s{i}/BitVector_Files")
    found = files.summaries(spark, f"{folder}/*/BitVector_Files")
    return found.groupBy("sample_id").agg(F.count("*").alias("rows"), F.sum(reports.number(F.col("num_reads"))).alias("reads"))


def _sam_mode(text: str) -> str:
    """The tables' SQL with all letters of CIGARs."""
    for old, new in (("([A-Z])'", "([A-Z=])'"), ("op IN ('M', 'D')", "op IN ('M', '=', 'X', 'D', 'N')"), ("op IN ('M', 'I', 'S')", "op IN ('M', '=', 'X', 'I', 'S')"), ("op NOT IN ('M', 'D', 'I', 'S')", "op NOT IN ('M', '=', 'X', 'D', 'N', 'I', 'S', 'H', 'P')"), ("op = 'D'", "op IN ('D', 'N')"), ("op = 'M'", "op IN ('M', '=', 'X')")):
        text = text.replace(old, new)
    return text


_TWO = "a AS (SELECT o_orderkey AS k, o_totalprice AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 7 <> 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice + 0.005 WHEN o_orderkey % 13 = 0 THEN o_totalprice + 1.0 ELSE o_totalprice END AS p, CASE WHEN o_orderkey % 17 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 5 <> 0), met AS (SELECT coalesce(a.k, b.k) AS k, a.k IS NULL AS no_a, b.k IS NULL AS no_b, a.p AS pa, b.p AS pb, a.s AS sa, b.s AS sb FROM a FULL JOIN b ON a.k = b.k)"
_FILES = "names AS (SELECT DISTINCT concat('s', l_suppkey % 20) AS sample_id, l_orderkey AS chunk, CASE WHEN l_linenumber % 4 = 0 THEN 1 ELSE l_linenumber % 2 + 1 END AS mate, concat('/runs/s', l_suppkey % 20, '_chunk', l_orderkey, CASE WHEN l_linenumber % 4 = 0 THEN '' ELSE concat('_', l_linenumber % 2 + 1) END, '.fastq.gz') AS file FROM lineitem)"
_STATS = "stats AS (SELECT *, s = 3 AND c = 3 AS broken FROM (SELECT o_custkey % 12 AS s, o_orderkey % 5 AS c, sum(o_orderkey)::BIGINT AS total, sum(o_custkey)::BIGINT AS un, count(*) AS uniq FROM orders GROUP BY ALL))"
_NUMBER = "regexp_extract(rname, '(\\d+)$', 1)::BIGINT"

ORACLE: dict[str, str] = {
    "reused_summary": KNOWN["summary"],
    "merge_files": KNOWN["merge_chunks"],
    "merge_files_strict": sql(f"SELECT b.rname, pos, count(*) FILTER (bit <> '?') AS cov, count(*) AS info, count(*) FILTER (bit IN {BASE}) AS mut, count(*) FILTER (bit = '1' AND split_part(b.key, ':', 1)::BIGINT % {PARTS} = 0) AS del FROM bits1 b JOIN frags f ON b.key = f.key AND f.reason IS NULL WHERE pos BETWEEN 1 AND 64 GROUP BY b.rname, pos"),
    "merged_histograms": sql("SELECT c.rname, num_reads, num_aligned, coalesce(m.mutations, 0)::BIGINT AS mutations FROM plain_counts c LEFT JOIN (SELECT rname, sum(n_mut * reads) AS mutations FROM nmut_counts GROUP BY rname) m ON c.rname = m.rname"),
    "merge_refused": sql(f"SELECT rname, 'data_type' AS field, 2::BIGINT AS kinds FROM refs WHERE {_NUMBER} % 10 = 0 UNION ALL SELECT rname, 'sequence', 2 FROM refs WHERE {_NUMBER} % 15 = 0 AND reverse(sequence) <> sequence"),
    "result_differences": f"WITH {_TWO}, kinds AS (SELECT CASE WHEN no_b THEN 'only left' WHEN no_a THEN 'only right' WHEN abs(pa - pb) > 0.01 OR sa <> sb THEN 'values' END AS difference FROM met) SELECT difference, count(*) AS n FROM kinds WHERE difference IS NOT NULL GROUP BY difference",
    "difference_rows": f"WITH {_TWO} SELECT k, CASE WHEN no_b THEN 'only left' ELSE 'only right' END AS difference, NULL::VARCHAR AS column, NULL::DOUBLE AS left_number, NULL::DOUBLE AS right_number FROM met WHERE no_a OR no_b UNION ALL SELECT k, 'values', 'o_totalprice', round(pa, 2), round(pb, 2) FROM met WHERE abs(pa - pb) > 0.01 UNION ALL SELECT k, 'values', 'o_orderstatus', NULL, NULL FROM met WHERE sa <> sb",
    "chunk_file_pairs": f"WITH {_FILES} SELECT sample_id, chunk, min(file) FILTER (mate = 1) AS r1, min(file) FILTER (mate = 2) AS r2, CASE WHEN count(*) FILTER (mate = 1) > 1 OR count(*) FILTER (mate = 2) > 1 THEN 'repeated' WHEN count(*) FILTER (mate = 1) = 0 THEN 'no first mate' WHEN count(*) FILTER (mate = 2) = 0 THEN 'single' ELSE 'paired' END AS kind FROM names GROUP BY sample_id, chunk",
    "chunk_file_lists": f"WITH {_FILES} SELECT sample_id, mate::INT AS mate, chunk // 1000 AS piece, string_agg(file, ',' ORDER BY chunk, file) AS files FROM names GROUP BY ALL",
    "stats_scan": f"WITH {_STATS} SELECT concat('s', s) AS sample_id, c::INT AS chunk, CASE WHEN NOT broken THEN concat('ref', s) END AS reference, CASE WHEN NOT broken THEN s % 2 = 0 END AS is_paired_end, CASE WHEN NOT broken THEN total END AS total_reads, CASE WHEN NOT broken AND c <> 1 THEN total - un END AS aligned_count, CASE WHEN NOT broken THEN un END AS unaligned_count, CASE WHEN NOT broken AND c <> 2 THEN uniq END AS unique_alignments, broken FROM stats",
    "stats_report": f"WITH {_STATS} SELECT concat('s', s) AS sample_id, sum(total)::BIGINT AS total_reads, sum(total - un)::BIGINT AS aligned_count, sum(un)::BIGINT AS unaligned_count, (sum(uniq) FILTER (c <> 2))::BIGINT AS unique_alignments, sum(total - un)::DOUBLE / sum(total)::DOUBLE * 100 AS overall_alignment_rate, (sum(uniq) FILTER (c <> 2))::DOUBLE / sum(total)::DOUBLE * 100 AS unique_percent, count(*) AS chunks_processed FROM stats WHERE NOT broken GROUP BY s",
    "fasta_faults": sql(f"SELECT message, count(*) AS n FROM (SELECT unnest([CASE WHEN n % 11 = 0 THEN 'no space may follow >' WHEN n % 13 = 0 THEN 'a name line must start with >' END, CASE WHEN n % 17 = 0 THEN 'a sequence may have only A, C, G and T' WHEN n % 19 = 0 THEN 'blank line' WHEN n % 23 = 0 THEN 'a sequence line may not start with >' END]) AS message FROM (SELECT {_NUMBER} AS n FROM refs)) WHERE message IS NOT NULL GROUP BY message"),
    "fastq_faults": sql("SELECT message, count(*) AS n FROM (SELECT CASE WHEN n % 11 = 0 THEN 'a record must start with @' WHEN n % 13 = 0 THEN 'the third line of a record must start with +' WHEN n % 17 = 0 THEN 'sequence and qualities differ in length' END AS message FROM (SELECT split_part(qname, ':', 1)::BIGINT AS n FROM mates WHERE mate = 1)) WHERE message IS NOT NULL GROUP BY message"),
    "structure_faults": sql(f"SELECT rname AS name, CASE WHEN n % 2 = 1 THEN 'no structure' ELSE 'name is repeated' END AS message FROM (SELECT rname, {_NUMBER} AS n FROM refs) WHERE n % 2 = 1 OR n % 30 = 0 UNION ALL SELECT concat('no_', rname), 'no such reference' FROM refs WHERE {_NUMBER} % 50 = 0"),
    "structures_scan": sql("SELECT name, sequence, structure FROM structures JOIN refs ON rname = name"),
    "samples_scan": "SELECT CASE WHEN c_custkey % 3 <> 0 THEN concat('s', c_custkey) ELSE concat('sample_r', c_custkey) END AS sample_id, concat('/lib/r', c_custkey, '.fasta') AS fasta, concat(c_custkey, '_1.fq') AS fastq1, CASE WHEN c_custkey % 2 = 0 THEN concat(c_custkey, '_2.fq') END AS fastq2, NULL::VARCHAR AS dot_bracket FROM customer",
    "trials_scan": KNOWN["param_mode"],
    "mapped_reads": sql("SELECT qname, '0' AS flag, pos, CASE WHEN pos % 2 = 0 THEN cigar ELSE '' END AS md_string, false AS paired FROM mates WHERE mate = 1 AND split_part(key, ':', 1)::BIGINT % 5 <> 0"),
    "sam_mode_bits": _sam_mode(sql("SELECT qname, count(*) AS symbols, coalesce(sum(pos) FILTER (bit = '0'), 0)::BIGINT AS matched, coalesce(sum(pos) FILTER (bit IN ('1', '?')), 0)::BIGINT AS gone FROM bits1 GROUP BY qname")),
    "json_array_roundtrip": KNOWN["json_roundtrip"],
    "joined_vectors": KNOWN["text_roundtrip"],
    "storage_formats": sql(f"SELECT f AS format, count(*) AS vectors, sum(m)::BIGINT AS mutations FROM (SELECT key, coalesce((SELECT count(*) FROM bits1 b WHERE b.key = f.key AND b.bit IN {BASE} AND b.pos BETWEEN 1 AND 64), 0) AS m FROM frags f WHERE reason IS NULL), (SELECT unnest(['text', 'json']) AS f) GROUP BY f"),
    "blank_line_stop": sql("SELECT qname, rname, mapq FROM mates WHERE mate = 1 AND mapq % 3 = 0"),
    "first_violations": sql(f"SELECT part, min(i) AS number, arg_min(message, i) AS message FROM (SELECT *, CASE WHEN n % 101 = 0 THEN 'a record must start with @' WHEN n % 103 = 0 THEN 'the third line of a record must start with +' END AS message FROM (SELECT split_part(qname, ':', 1)::BIGINT AS n, split_part(qname, ':', 1)::BIGINT % {PARTS} AS part, row_number() OVER (PARTITION BY split_part(qname, ':', 1)::BIGINT % {PARTS} ORDER BY qname) - 1 AS i FROM mates WHERE mate = 1)) WHERE message IS NOT NULL GROUP BY part"),
    "totals_files": KNOWN["alignment_totals"],
    "summaries_scan": "SELECT concat('s', o_orderkey % 4) AS sample_id, count(*) AS rows, (sum(o_custkey) FILTER (o_orderkey % 7 <> 0))::DOUBLE AS reads FROM orders GROUP BY o_orderkey % 4",
    "stream_pairs": sql("SELECT rname, kind, count(*) AS n FROM (SELECT rname, 'pair' AS kind FROM pairs WHERE split_part(key, ':', 1)::BIGINT % 7 <> 0 UNION ALL SELECT rname, 'orphan' FROM mates WHERE mate = 1 AND split_part(key, ':', 1)::BIGINT % 7 = 0) GROUP BY rname, kind"),
}
