"""Queries over the driver's tables: each applies operators to reads, references and other rows that synth.py or the
query itself derives from whole tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.functions import texts
from strandframe.functions.columns import deletion_is_ambiguous
from strandframe.model import BitVectorConfig, StricterConstraints
from strandframe.operators import chunks, filters, histogram, quality, reads, render, reports, trials, vectors
from strandframe.plans import synth
from strandframe.session import shared_dir, stage
from strandframe.sinks import files as sinks
from strandframe.sources import files
from strandframe.streaming import merge

Query = Callable[[SparkSession, str], DataFrame]
STRICT = BitVectorConfig(stricter=StricterConstraints(5, 0.4, 2))
QUERIES: dict[str, Query] = {}
#: Micro-batches of a stream of reads, at most.
BATCHES = 8


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _fragments(spark: SparkSession, d: str, config: BitVectorConfig = BitVectorConfig()) -> DataFrame:
    return vectors.single_fragments(synth.reads(spark, d), synth.references(spark, d), config)


def _judged(spark: SparkSession, d: str, config: BitVectorConfig = BitVectorConfig()) -> DataFrame:
    return filters.with_reason(_fragments(spark, d, config), config)


def _packed(spark: SparkSession, d: str) -> DataFrame:
    """_judged() with vectors as text."""
    return filters.with_reason(vectors.single_fragments(synth.reads(spark, d), synth.references(spark, d), packed=True))


def _mates(spark: SparkSession, d: str) -> DataFrame:
    return synth.mates(spark, d).select("qname", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "seq", "qual", "mate")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return vectors.consistent_pairs(_mates(spark, d))


def _with_part(judged: DataFrame) -> DataFrame:
    """judged with part, one of four, by the order that a read's name begins with."""
    return judged.withColumn("part", F.pmod(F.split("qname", ":")[0].cast("long"), F.lit(4)))


def _tallied(spark: SparkSession, d: str, config: BitVectorConfig = BitVectorConfig(), *by: str) -> DataFrame:
    """All counts, made in one pass over the reads and staged: a row for each position and number of mutations."""
    judged = filters.with_reason(vectors.single_fragments(synth.reads(spark, d), synth.references(spark, d), config, lazy=True), config)
    return stage(histogram.tallies(_with_part(judged) if by else judged, *by), "tallies")


def _fragment_counts(spark: SparkSession, d: str, *by: str) -> DataFrame:
    """The counts that need no positions, staged."""
    judged = filters.with_reason(vectors.single_fragments(synth.reads(spark, d), synth.references(spark, d), lazy=True))
    return stage(histogram.fragment_counts(_with_part(judged) if by else judged, *by), "fragment-counts")


def _dense(spark: SparkSession, d: str) -> DataFrame:
    return histogram.dense_positions(histogram.positions(_packed(spark, d)), synth.references(spark, d))


def _counts(spark: SparkSession, d: str, config: BitVectorConfig = BitVectorConfig()) -> DataFrame:
    return histogram.with_all_references(histogram.read_counts(_judged(spark, d, config)), synth.references(spark, d))


def _orders(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{d}/orders.parquet").select(*columns)


@query
def synth_refs(spark, d):
    return synth.references(spark, d)


@query
def synth_reads(spark, d):
    return synth.mates(spark, d).drop("tlen", "md_string", "key")


@query
def cigar_ops(spark, d):
    ops = vectors.placed_ops(F.col("cigar"), F.col("pos"))
    return synth.reads(spark, d).select("qname", F.posexplode(ops).alias("op_index", "o")).select("qname", "op_index", "o.len", "o.op")


@query
def cigar_cursor(spark, d):
    ops = vectors.placed_ops(F.col("cigar"), F.col("pos"))
    return synth.reads(spark, d).select("qname", F.posexplode(ops).alias("op_index", "o")).select("qname", "op_index", "o.i", "o.j", F.col("o.last").alias("is_last"))


@query
def read_bits(spark, d):
    return _fragments(spark, d).select("qname", F.inline("bits"))


@query
def match_bits(spark, d):
    plain = synth.reads(spark, d).filter("cigar = '40M'")
    return vectors.single_fragments(plain, synth.references(spark, d)).select("qname", F.inline("bits"))


@query
def quality_mask(spark, d):
    return _fragments(spark, d).select("rname", F.inline("bits")).groupBy("rname").agg(F.sum((F.col("bit") == "?").cast("int")).cast("long").alias("ambiguous"), F.count("*").alias("symbols"))


@query
def deletion_ambiguity(spark, d):
    known = vectors.with_reference(synth.reads(spark, d), synth.references(spark, d))
    ops = known.select("qname", "sequence", F.explode(vectors.placed_ops(F.col("cigar"), F.col("pos"))).alias("o"), "cigar").filter("o.op = 'D' and cigar rlike '^([0-9]+[MDIS])+$'")
    return ops.select("qname", deletion_is_ambiguous(F.col("sequence"), F.col("o.i") + F.col("o.len") - 1, F.col("o.len"), 10).alias("ambiguous"))


@query
def softclip_bits(spark, d):
    return _fragments(spark, d).select("qname", F.inline("bits")).filter("bit = '*'").select("qname", "pos")


@query
def unknown_op_empty(spark, d):
    r = synth.reads(spark, d)
    bits = vectors.read_bits(*(F.col(c) for c in ("cigar", "pos", "seq", "qual", "sequence")))
    return vectors.with_reference(r, synth.references(spark, d)).filter(F.size(bits) == 0).select("qname", "cigar")


@query
def bitvector_text(spark, d):
    b, one, end = F.col("bits"), F.lit(1), F.col("ref_length")
    return _fragments(spark, d).select("qname", "rname", render.dense_text(b, one, end).alias("bits"), render.letter_count(b, one, end).cast("long").alias("n_letters"))


@query
def sparse_muts(spark, d):
    return _fragments(spark, d).select("qname", *[render.sparse_text(F.col("bits"), k).alias(k) for k in ("muts", "dels", "ambigs")])


@query
def pair_consistency(spark, d):
    return _pairs(spark, d).select("qname", "rname", F.col("r1.mapq").alias("mapq"))


@query
def pair_merge(spark, d):
    return vectors.paired_fragments(_pairs(spark, d), synth.references(spark, d)).select("qname", F.inline("bits"))


@query
def pair_hist(spark, d):
    judged = filters.with_reason(vectors.packed_pair_fragments(_mates(spark, d), synth.references(spark, d)))
    return histogram.positions(judged).select("rname", "pos", "cov", "info", "mut", "del")


@query
def filter_reason(spark, d):
    return _judged(spark, d, STRICT).select("qname", "rname", "n_mut", "reason")


def _only(reason: str) -> Query:
    return lambda spark, d: _judged(spark, d, STRICT).filter(F.col("reason") == reason).select("qname")


QUERIES |= {f"filter_{r}": _only(r) for r in ("low_mapq", "short_read", "too_many_muts", "muts_too_close")}


@query
def rejected(spark, d):
    return filters.rejected(_judged(spark, d, STRICT))


@query
def unknown_reference(spark, d):
    known = synth.structures(spark, d).select(F.col("name").alias("rname"))
    return vectors.unknown_references(synth.reads(spark, d), known).select("qname", "rname")


@query
def csv_fasta_check(spark, d):
    return synth.references(spark, d).join(synth.structures(spark, d).select(F.col("name").alias("rname")), "rname", "left_anti").select("rname")


@query
def hist_pos(spark, d):
    return histogram.positions(_judged(spark, d))


@query
def hist_nmut(spark, d):
    return histogram.mutation_counts(_judged(spark, d))


@query
def hist_reads(spark, d):
    return _counts(spark, d, STRICT)


@query
def hist_dense(spark, d):
    return _dense(spark, d).select("rname", "pos", "nuc", "cov", "info", "mut", "del")


def _parts(spark: SparkSession, d: str) -> list[DataFrame]:
    """The counts of fragments of four parts of the reads, by a hash of their names."""
    tallied = _fragment_counts(spark, d, "part")
    return [tallied.filter(F.col("part") == i).drop("part") for i in range(4)]


@query
def merge_chunks(spark, d):
    return histogram.merge_parts(histogram.positions(_with_part(_judged(spark, d)), "part"), "part")


@query
def merge_mutation_counts(spark, d):
    return histogram.merge_mutation_counts([histogram.of_mutations(p) for p in _parts(spark, d)])


@query
def merge_read_counts(spark, d):
    return histogram.merge_read_counts([histogram.of_reads(p) for p in _parts(spark, d)])


@query
def merge_chunks_strict(spark, d):
    counted = histogram.positions(_with_part(_judged(spark, d)), "part")
    return histogram.merge_parts(counted, "part", strict_first=0).select("rname", "pos", "cov", "info", "mut", "del")


@query
def merge_guards(spark, d):
    described = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_brand").alias("rname"), F.col("p_type").alias("sequence"))
    return histogram.merge_conflicts([described], by=("sequence",))


@query
def pop_avg(spark, d):
    return histogram.population_average(_dense(spark, d), synth.structures(spark, d))


@query
def mutation_rate(spark, d):
    return histogram.population_average(_dense(spark, d)).select("rname", "position", "mismatches")


@query
def read_coverage(spark, d):
    tallied, refs = _tallied(spark, d), synth.references(spark, d)
    dense = histogram.dense_positions(histogram.of_positions(tallied), refs)
    return histogram.read_coverage(dense, histogram.with_all_references(histogram.of_reads(tallied), refs))


@query
def percent_mutations(spark, d):
    return histogram.fragment_shares(_judged(spark, d), synth.references(spark, d))


@query
def signal_to_noise(spark, d):
    return histogram.signal_to_noise(_dense(spark, d))


@query
def summary(spark, d):
    tallied = _tallied(spark, d)
    return histogram.summary(synth.references(spark, d), histogram.of_positions(tallied), histogram.of_mutations(tallied), histogram.of_reads(tallied))


@query
def report_columns(spark, d):
    columns = ("name", "structure", "reads", "num_aligned", "aligned", "no_mut", "1_mut", "2_mut", "3_mut", "3plus_mut", "sn")
    return histogram.report(synth.references(spark, d), _tallied(spark, d), columns, synth.structures(spark, d))


@query
def report_series(spark, d):
    columns = ("name", "cov_bases", "info_bases", "mut_bases", "del_bases", "read_coverage", "pop_avg", "pop_avg_del")
    wide = histogram.report(synth.references(spark, d), _tallied(spark, d), columns)
    each = wide.select("name", F.posexplode(F.arrays_zip(*columns[1:])).alias("at", "x"))
    return each.select("name", (F.col("at") + 1).alias("pos"), "x.*")


@query
def report_mutations(spark, d):
    wide = histogram.report(synth.references(spark, d), histogram.fragment_counts(_judged(spark, d)), ("name", "num_of_mutations"))
    return wide.select("name", F.posexplode("num_of_mutations").alias("n_mut", "reads")).filter("reads > 0")


@query
def skip_summary(spark, d):
    return histogram.skip_summary(_counts(spark, d, STRICT))


@query
def nonempty_distribution(spark, d):
    return _judged(spark, d).filter(F.size("bits") > 0).groupBy("n_mut").agg(F.count("*").alias("reads"))


@query
def impl_diff(spark, d):
    """Position counts of whole-table and of merged counting, compared."""
    merged = histogram.merge_parts(histogram.positions(_with_part(_packed(spark, d)), "part"), "part")
    return reports.block_differences(histogram.positions(_packed(spark, d)), merged, ["rname", "pos"])


@query
def chunk_assign(spark, d):
    return chunks.assign(_orders(spark, d, "o_orderkey"), 1000, "o_orderkey")


@query
def chunk_pairs(spark, d):
    return chunks.pair_chunks(spark.read.parquet(f"{d}/lineitem.parquet"), "l_orderkey", F.col("l_linenumber") % 2 == 1)


@query
def chunk_cross_index(spark, d):
    index = spark.read.parquet(f"{d}/nation.parquet").orderBy("n_nationkey").limit(1).select("n_name")  # one row
    return _orders(spark, d, "o_orderkey").join(F.broadcast(index))


@query
def sample_names(spark, d):
    name = F.concat(F.lit("s"), (F.col("o_custkey") % 50).cast("string"), F.lit("_chunk"), (F.col("o_orderkey") % 9).cast("string"))
    return _orders(spark, d, "o_orderkey", "o_custkey").select("o_orderkey", chunks.sample_of(name).alias("sample_id"), chunks.chunk_of(name).alias("chunk"))


@query
def alignment_totals(spark, d):
    stats = _orders(spark, d, "o_orderkey", "o_custkey").select((F.col("o_custkey") % 50).alias("sample_id"), F.col("o_orderkey").alias("total_reads"), F.lit(None).cast("long").alias("aligned_count"), (F.col("o_custkey") % 10).alias("unaligned_count"))
    return reports.alignment_totals(stats, "sample_id")


@query
def column_stats(spark, d):
    cell = F.when(F.col("o_orderkey") % 5 == 0, "NA").when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.col("o_custkey").cast("string"))
    return reports.column_stats(_orders(spark, d, "o_orderkey", "o_custkey").select(cell.alias("v")), "v")


@query
def mutated_share(spark, d):
    cell = F.when(F.col("o_orderkey") % 5 == 0, "NA").otherwise((F.col("o_custkey") % 3).cast("string"))
    return reports.mutated_share(_orders(spark, d, "o_orderkey", "o_custkey").select(cell.alias("v")), "v")


def _top(spark: SparkSession, d: str) -> DataFrame:
    orders = _orders(spark, d, "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority", "o_custkey")
    searched = orders.select(F.col("o_orderkey").alias("trial"), F.col("o_totalprice").alias("quality_score"), F.col("o_orderstatus").alias("p_status"), F.col("o_orderpriority").alias("p_priority"), (F.col("o_custkey") % 7).cast("string").alias("p_cust"))
    return trials.top(searched, 100)


@query
def top_params(spark, d):
    return _top(spark, d)


@query
def param_frequency(spark, d):
    return trials.frequency(trials.long(_top(spark, d))).select("param", "value", "n", "frequency")


@query
def param_mode(spark, d):
    return trials.modes(trials.frequency(trials.long(_top(spark, d))))


@query
def param_class(spark, d):
    return trials.classes(trials.modes(trials.frequency(trials.long(_top(spark, d)))))


@query
def score_stats(spark, d):
    return trials.score_stats(_top(spark, d))


@query
def union_sam(spark, d):
    m = synth.mates(spark, d).select("qname", "rname", "pos", "mate")
    return m.filter("mate = 1").unionByName(m.filter("mate = 2"))


@query
def fastq_qc(spark, d):
    return quality.cycle_quality(synth.mates(spark, d))


@query
def demultiplex(spark, d):
    """Barcodes of two letters for the first sixteen nations; reads by the one they begin with."""
    letter = [F.substr(F.lit("ACGT"), x.cast("int") + 1, F.lit(1)) for x in (F.floor(F.col("n_nationkey") / 4), F.col("n_nationkey") % 4)]
    barcodes = spark.read.parquet(f"{d}/nation.parquet").filter("n_nationkey < 16").select(F.col("n_name").alias("sample_id"), F.concat(*letter).alias("barcode"))
    return reads.demultiplex(synth.mates(spark, d).select("qname", "mate", "seq", "qual"), barcodes)


@query
def barcode_counts(spark, d):
    return reads.barcode_counts(synth.mates(spark, d), 2)


@query
def quality_trim(spark, d):
    return reads.quality_trim(synth.mates(spark, d).select("qname", "mate", "seq", "qual"), 25, 20)


def _streamed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The reads, written as files, counted as a stream of micro-batches and merged."""
    folder = shared_dir(spark, "stream")
    source = synth.reads(spark, d, gathered=True).drop("key")  # a micro-batch has its references, not a few reads of all
    source.write.parquet(f"{folder}/in", compression="zstd")
    written = len(spark.read.schema(source.schema).parquet(f"{folder}/in").inputFiles())
    each = max(4, math.ceil(written / BATCHES))  # each micro-batch meets all references
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", each).parquet(f"{folder}/in")
    merge.count_stream(stream, synth.references(spark, d), f"{folder}/out", f"{folder}/state").awaitTermination()
    return merge.merged(spark, f"{folder}/out")


@query
def stream_merge(spark, d):
    return _streamed(spark, d)[0]


@query
def stream_summary(spark, d):
    """The summary of a stream's counts."""
    pos, nmut, counts = _streamed(spark, d)
    return histogram.summary(synth.references(spark, d), pos, nmut, counts)


@query
def positional_pairs(spark, d):
    """The mates, written as SAM lines that follow each other, paired by their places."""
    folder = shared_dir(spark, "sam")
    sinks.sam(synth.mates(spark, d), synth.references(spark, d), folder, "key", "mate")
    return vectors.positional_pairs(files.numbered_sam(spark, folder)).select("qname", "rname", F.col("r1.mapq").alias("mapq"))


@query
def orphans(spark, d):
    """Reads without the second mates of every seventh order."""
    gone = (F.col("mate") == 2) & (F.split("key", ":")[0].cast("long") % 7 == 0)
    return vectors.orphans(synth.mates(spark, d).filter(~gone)).select("qname", "rname", "pos", "cigar")


@query
def sam_scan(spark, d):
    folder = shared_dir(spark, "sam")
    sinks.sam(synth.mates(spark, d), synth.references(spark, d), folder)
    return files.with_mate(files.sam(spark, folder)).select("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "seq", "qual", "mate")


@query
def joined_sam(spark, d):
    """The mates, written as two chunks and joined."""
    folder = shared_dir(spark, "sam")
    for m in (1, 2):
        sinks.sam(synth.mates(spark, d).filter(F.col("mate") == m), synth.references(spark, d), f"{folder}/{m}")
    sinks.joined_sam(spark, [f"{folder}/1", f"{folder}/2"], f"{folder}/all")
    return files.sam(spark, f"{folder}/all/*").select("qname", "rname", "pos", "flag")


@query
def fasta_scan(spark, d):
    folder = shared_dir(spark, "fasta")
    synth.references(spark, d).select(F.concat(F.lit(">"), F.col("rname"), F.lit("\n"), F.col("sequence")).alias("value")).write.text(folder)
    return files.fasta(spark, folder)


@query
def fastq_scan(spark, d):
    """The first mates in chunks of a thousand reads by key, written as FASTQ and read back."""
    folder = shared_dir(spark, "fastq")
    sinks.fastq_chunks(chunks.numbered(synth.reads(spark, d).select("qname", "seq", "qual"), "qname").withColumn("chunk", F.floor(F.col("row") / 1000)), folder)
    return files.fastq(spark, f"{folder}/*").select("qname", "seq", "qual")


@query
def json_roundtrip(spark, d):
    """Accepted vectors as JSON lines and back: their mutations, deletions and ambiguous symbols, counted."""
    folder = shared_dir(spark, "json")
    sinks.bit_vectors_json(_judged(spark, d), folder)
    each = files.bit_vectors_json(spark, folder).select("rname", F.inline("bits"))
    return each.groupBy("rname", "pos", "bit").agg(F.count("*").alias("n"))


@query
def text_roundtrip(spark, d):
    """Accepted vectors as text, a file for each reference, and back."""
    folder = shared_dir(spark, "text")
    sinks.bit_vectors_text(_packed(spark, d), folder)
    return texts.symbols(files.bit_vector_text(spark, f"{folder}/*/*", packed=True), "qname", "rname")


@query
def histogram_roundtrip(spark, d):
    """Histograms as JSON and back: the counts of positions."""
    folder, tallied = shared_dir(spark, "histograms"), _tallied(spark, d)
    sinks.histogram_json(synth.references(spark, d), histogram.of_positions(tallied), histogram.of_mutations(tallied), histogram.of_reads(tallied), folder, structures=synth.structures(spark, d))
    return files.histogram_json(spark, folder)[0]


@query
def grouped_chunks(spark, d):
    """Chunks of orders by customer, with the customer's name."""
    cut = _orders(spark, d, "o_orderkey", "o_custkey").select(F.col("o_custkey").alias("sample_id"), F.floor(F.col("o_orderkey") / 1000).alias("chunk")).distinct()
    samples = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("sample_id"), "c_name")
    return chunks.of_samples(cut, samples)


@query
def workflow_report(spark, d):
    """Orders as chunks of an alignment, customers as rows of a summary."""
    stats = _orders(spark, d, "o_orderkey", "o_custkey").select(F.col("o_orderkey").alias("total_reads"), F.lit(None).cast("long").alias("aligned_count"), (F.col("o_custkey") % 10).alias("unaligned_count"))
    cell = F.when(F.col("c_custkey") % 5 == 0, "NA").otherwise((F.col("c_custkey") % 3).cast("string"))
    rows = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").cast("string").alias("num_reads"), cell.alias("num_mutations"))
    return reports.workflow_report(stats, rows, "num_reads", "num_mutations", mutations="num_mutations")


@query
def alignment_log(spark, d):
    """Logs of an aligner made of orders, and parsed."""
    n, once, more = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_custkey") % 7
    text = F.concat(n.cast("string"), F.lit(" reads; of these:\n    "), more.cast("string"), F.lit(" (1.50%) aligned 0 times\n    "), once.cast("string"), F.lit(" (97.25%) aligned exactly 1 time\n98.50% overall alignment rate\n"))
    parsed = _orders(spark, d, "o_orderkey", "o_custkey").select("o_orderkey", reports.parse_alignment_log(text).alias("log"))
    return parsed.select("o_orderkey", "log.total_reads", "log.unaligned_count", "log.unique_count", "log.unique_percent", "log.multiple_count", "log.overall_alignment_rate")


@query
def quality_score(spark, d):
    parts = [(F.col("o_custkey") % 100) / 100.0, (F.col("o_orderkey") % 100) / 100.0, (F.col("o_orderkey") % 80).cast("double"), (F.col("o_custkey") % 10) / 10.0]
    return _orders(spark, d, "o_orderkey", "o_custkey").select("o_orderkey", reports.quality_score(*parts).alias("score"))
