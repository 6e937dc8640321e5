"""Chunks of a read set: numbering, assignment, pairing of mates' chunks, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandframe.session import stage


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """df with ``row``, its rows' number from 0 in an order over all, without a task that holds all rows: rows are
    sorted into ranges, numbered within each, and moved on by the rows of the ranges before.

    The numbered ranges are staged: both uses must see the same ranges, whatever is planned or lost in between.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("n_part", F.spark_partition_id()).withColumn("n_inner", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    ranged = stage(ranged, "numbered")
    before = Window.orderBy("b_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sizes = ranged.groupBy(F.col("n_part").alias("b_part")).agg(F.count("*").alias("n_rows"))
    base = sizes.select("b_part", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("n_base"))
    return ranged.join(base, F.col("n_part") == F.col("b_part")).withColumn("row", F.col("n_base") + F.col("n_inner")).drop("n_part", "b_part", "n_base", "n_inner")


def assign(df: DataFrame, size: int, *order: str) -> DataFrame:
    """df with ``chunk``: blocks of ``size`` rows in the order given."""
    return numbered(df, *order).withColumn("chunk", F.floor(F.col("row") / size).cast("long")).drop("row")


def of_samples(chunks: DataFrame, samples: DataFrame) -> DataFrame:
    """(sample_id, the columns of samples, n_chunks, first_chunk, last_chunk) of the samples that have chunks."""
    grouped = chunks.groupBy("sample_id").agg(F.count("*").alias("n_chunks"), F.min("chunk").alias("first_chunk"), F.max("chunk").alias("last_chunk"))
    return samples.join(grouped, "sample_id")


def pair_chunks(chunks: DataFrame, key: str, is_first: Column) -> DataFrame:
    """Files of both mates that belong to one chunk: (key, r1, r2), counted."""
    return chunks.groupBy(F.col(key).alias("chunk")).agg(F.sum(is_first.cast("int")).cast("long").alias("r1"), F.sum((~is_first).cast("int")).cast("long").alias("r2"))


def named_files(files: DataFrame, name: str) -> DataFrame:
    """(sample_id, chunk, mate, the columns of files) of chunks' files by their names, ``<sample>_chunk<number>_<mate>.fastq``
    (or .fq, with .gz): a name without a mate is of mate 1; one without a chunk is left out."""
    base = F.regexp_extract(F.col(name), r"([^/]*)$", 1)
    parts = [F.regexp_extract(base, r"^(.*?)_?chunk_?([0-9]+)(?:_R?([12]))?\.f(?:ast)?q(?:\.gz)?$", i) for i in (1, 2, 3)]
    return files.select(parts[0].alias("sample_id"), F.nullif(parts[1], F.lit("")).cast("long").alias("chunk"), F.coalesce(F.nullif(parts[2], F.lit("")).cast("int"), F.lit(1)).alias("mate"), *files.columns).filter("chunk is not null")


def paired_files(named: DataFrame, name: str) -> DataFrame:
    """(sample_id, chunk, r1, r2, kind) of named_files(): the files of both mates of each chunk, the first by name if there are
    several. kind: paired, single (no second mate: r2 null), no first mate, or repeated (more than one file of a mate)."""
    n = [F.count_if(F.col("mate") == m) for m in (1, 2)]
    files_ = [F.min(F.when(F.col("mate") == m, F.col(name))).alias(f"r{m}") for m in (1, 2)]
    kind = F.when((n[0] > 1) | (n[1] > 1), "repeated").when(n[0] == 0, "no first mate").when(n[1] == 0, "single").otherwise("paired")
    return named.groupBy("sample_id", "chunk").agg(*files_, kind.alias("kind"))


def file_lists(named: DataFrame, name: str, size: int = 1000) -> DataFrame:
    """(sample_id, mate, piece, files): a sample's files in the order of chunk, then name, in pieces of ``size`` chunk numbers,
    so a list is bounded whatever a sample has."""
    ordered = F.transform(F.array_sort(F.collect_set(F.struct("chunk", name))), lambda x: x[name])
    return named.groupBy("sample_id", "mate", F.floor(F.col("chunk") / size).alias("piece")).agg(ordered.alias("files"))


def sample_of(name: Column) -> Column:
    """The sample of a chunk's name (``s_chunk12`` -> ``s``)."""
    return F.regexp_replace(name, "_chunk[0-9]+$", "")


def chunk_of(name: Column) -> Column:
    """The number in a chunk's name, null without one."""
    return F.nullif(F.regexp_extract(name, "chunk_?([0-9]+)", 1), F.lit("")).cast("int")
