"""Run reports: totals of alignment statistics, statistics of summary columns, differences of two results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandframe.functions.columns import half_even
from strandframe.session import stage


def number(cell: Column) -> Column:
    """A cell of a CSV table as double; null if it is empty, NA or no number."""
    return F.when(F.trim(cell).isin("", "NA"), None).otherwise(F.trim(cell).try_cast("double"))


def alignment_totals(stats: DataFrame, *by: str) -> DataFrame:
    """Sums of (total_reads, aligned_count, unaligned_count[, unique_alignments, multiple_alignments]) over the chunks of
    each group, and the rate; a missing aligned_count is total less unaligned."""
    optional = [c for c in ("unique_alignments", "multiple_alignments") if c in stats.columns]
    aligned = F.coalesce("aligned_count", F.col("total_reads") - F.col("unaligned_count"))
    sums = stats.groupBy(*by).agg(F.sum("total_reads").cast("long").alias("total_reads"), F.sum(aligned).cast("long").alias("aligned_count"), F.sum("unaligned_count").cast("long").alias("unaligned_count"), *[F.sum(c).cast("long").alias(c) for c in optional], F.count("*").alias("chunks_processed"))
    total = F.nullif(F.col("total_reads"), F.lit(0))
    shares = [(F.col(c) / total * 100).alias(c.replace("alignments", "percent")) for c in optional]
    return sums.select("*", (F.col("aligned_count") / total * 100).alias("overall_alignment_rate"), *shares)


def column_stats(df: DataFrame, *columns: str) -> DataFrame:
    """avg, min, max, total and number of the numeric cells of each column."""
    aggs = [f(number(F.col(c).cast("string"))).alias(f"{n}_{c}" if len(columns) > 1 or n != "n" else "n") for c in columns for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max), ("total", F.sum), ("n", F.count))]
    return df.agg(*aggs)


def mutated_share(df: DataFrame, column: str) -> DataFrame:
    """Rows whose cell is above 0, and their share in percent of all rows."""
    n = F.sum(F.coalesce(number(F.col(column)) > 0, F.lit(False)).cast("int")).cast("long")
    return df.agg(n.alias("sequences_with_mutations"), (n / F.nullif(F.count("*"), F.lit(0)) * 100).alias("mutation_rate"))


def workflow_report(alignment: DataFrame, rows: DataFrame, *columns: str, mutations: str | None = None) -> DataFrame:
    """One row for a run: totals and rate of its alignment chunks, number of sequences, statistics of the summary's
    numeric columns and, if the column is named, the share of sequences with mutations."""
    totals = alignment_totals(alignment)
    parts = [totals.withColumn("parallel_mode", F.col("chunks_processed") > 1), rows.agg(F.count("*").alias("sequences_analyzed"))]
    if columns:
        stats = [f(number(F.col(c).cast("string"))).alias(f"{n}_{c}") for c in columns for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max), ("total", F.sum))]
        parts.append(rows.agg(*stats))
    if mutations:
        parts.append(mutated_share(rows, mutations))
    out = parts[0]
    for part in parts[1:]:
        out = out.join(F.broadcast(part))  # one row each
    return out


def parse_alignment_log(text: Column) -> Column:
    """The figures of an aligner's log as a struct; null where a line is missing."""
    def one(pattern: str, kind: str, group: int = 1) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).cast(kind)

    lines = {"unaligned": "aligned 0 times", "unique": "aligned exactly 1 time", "multiple": "aligned >1 times", "concordant_0": "aligned concordantly 0 times", "concordant_1": "aligned concordantly exactly 1 time", "concordant_multiple": "aligned concordantly >1 times", "discordant": "aligned discordantly 1 time"}
    cells = [one(r"(\d+) reads; of these:", "long").alias("total_reads"), one(r"([\d.]+)% overall alignment rate", "double").alias("overall_alignment_rate")]
    for name, line in lines.items():
        cells += [one(rf"(\d+) \(([\d.]+)%\) {line}", "long").alias(f"{name}_count"), one(rf"(\d+) \(([\d.]+)%\) {line}", "double", 2).alias(f"{name}_percent")]
    return F.struct(*cells)


def differences(a: DataFrame, b: DataFrame, keys: list[str], tolerance: float = 0.0) -> DataFrame:
    """(difference, n): rows by key that only one side has, or whose values differ by more than the tolerance; one row
    ``none`` if there are none. One shuffle of each side, on the keys."""
    values = [c for c in a.columns if c not in keys]
    left = a.select(*keys, F.struct(*values).alias("va"))
    right = b.select(*[F.col(k).alias(f"k_{k}") for k in keys], F.struct(*values).alias("vb"))
    on = [F.col(k).eqNullSafe(F.col(f"k_{k}")) for k in keys]
    kinds = dict(a.dtypes)

    def differ(c: str) -> Column:
        x, y = F.col(f"va.{c}"), F.col(f"vb.{c}")
        same = x.eqNullSafe(y)
        return ~(same | F.coalesce(F.abs(x - y) <= tolerance, F.lit(False))) if tolerance and kinds[c] in ("double", "float") else ~same

    changed = F.lit(False)
    for c in values:
        changed = changed | differ(c)
    kind = F.when(F.col("vb").isNull(), "only left").when(F.col("va").isNull(), "only right").when(changed, "values")
    names = ("only left", "only right", "values")
    counted = left.join(right, on, "full").agg(*[F.count_if(F.coalesce(kind == n, F.lit(False))).alias(n) for n in names])
    found = F.filter(F.array(*[F.struct(F.lit(n).alias("difference"), F.col(n).alias("n")) for n in names]), lambda x: x["n"] > 0)
    none = F.array(F.struct(F.lit("none").alias("difference"), F.lit(0).cast("long").alias("n")))
    return counted.select(F.inline(F.when(F.size(found) > 0, found).otherwise(none)))


#: Values of the last key whose rows move together, in block_differences().
BLOCK = 1024


def block_differences(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """differences() of two tables that have each key once, where the last key is a whole number with many neighbours (a
    position in a reference).

    Rows move as blocks of BLOCK values of the last key at most, so the other keys move once for each block; only rows of
    blocks that aren't equal are compared by key.
    """
    *outer, last = keys

    def blocks(df: DataFrame, name: str) -> DataFrame:
        row = F.struct(last, *[c for c in a.columns if c not in keys])
        return df.groupBy(*outer, F.floor(F.col(last) / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(row)).alias(name))

    left, right = blocks(a, "left"), blocks(b, "right").withColumnsRenamed({c: f"k_{c}" for c in (*outer, "block")})
    on = [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in (*outer, "block")]
    met = left.join(right, on, "full").filter(~F.col("left").eqNullSafe(F.col("right")))
    unlike = stage(met.select(*[F.when(F.col("left").isNull(), F.col(f"k_{c}")).otherwise(F.col(c)).alias(c) for c in outer], "left", "right"), "unlike-blocks")
    return differences(*[unlike.select(*outer, F.inline(side)) for side in ("left", "right")], keys)


def difference_rows(a: DataFrame, b: DataFrame, keys: list[str], tolerance: float = 0.0) -> DataFrame:
    """(keys, difference, column, left_value, right_value) of two results: a row for each cell that differs (``values``; by
    more than the tolerance, for numbers of floating point), and one for each key that only one side has. One shuffle of each
    side; equal keys of one side are compared with each of the other's."""
    values = [c for c in a.columns if c not in keys]
    kinds = dict(a.dtypes)
    left = a.select(*keys, F.struct(*values).alias("va"))
    right = b.select(*[F.col(k).alias(f"k_{k}") for k in keys], F.struct(*values).alias("vb"))
    met = left.join(right, [F.col(k).eqNullSafe(F.col(f"k_{k}")) for k in keys], "full")
    cells = []
    for c in values:
        x, y = F.col(f"va.{c}"), F.col(f"vb.{c}")
        near = F.coalesce(F.abs(x - y) <= tolerance, F.lit(False)) if tolerance and kinds[c] in ("double", "float") else F.lit(False)
        cells.append(F.when(~(x.eqNullSafe(y) | near), F.struct(F.lit("values").alias("difference"), F.lit(c).alias("column"), x.cast("string").alias("left_value"), y.cast("string").alias("right_value"))))

    def alone(side: str) -> Column:
        return F.array(F.struct(F.lit(f"only {side}").alias("difference"), F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("left_value"), F.lit(None).cast("string").alias("right_value")))

    every = F.when(F.col("vb").isNull(), alone("left")).when(F.col("va").isNull(), alone("right")).otherwise(F.filter(F.array(*cells), lambda x: x.isNotNull()))
    known = [F.when(F.col("va").isNull(), F.col(f"k_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    return met.select(*known, F.inline(every))


def quality_score(signal: Column, aligned: Column, mapq: Column, accepted: Column) -> Column:
    """Weighted score of a parameter set; all parts between 0 and 1, but the mapping quality between 0 and 60."""
    return half_even(0.4 * signal + 0.3 * aligned + 0.2 * F.least(mapq / 60.0, F.lit(1.0)) + 0.1 * accepted, 6)
