"""Quality control of raw reads (seq, qual).

What goes by cycle is read off one small table, cycle_counts(): a read is cut into letters once, and letters are added up
by (cycle, base, score) before the shuffle. Percentiles come from these counts, so nothing is sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandframe.functions.columns import phred
from strandframe.session import stage

LETTERS = ("A", "C", "G", "T", "N")


def cycle_counts(reads: DataFrame) -> DataFrame:
    """(cycle, base, score, n): how many reads have a base with a score at each cycle, from 1. A base without a quality
    has no score; reads that are null or empty have no cycle."""
    letters = F.arrays_zip(F.split("seq", "").alias("base"), F.split("qual", "").alias("letter"))
    each = reads.filter(F.length("seq") > 0).select(F.posexplode(letters).alias("at", "x")).filter(F.col("x.base") != "")
    score = F.when(F.col("x.letter") != "", phred(F.col("x.letter")))
    return each.select((F.col("at") + 1).alias("cycle"), F.col("x.base").alias("base"), score.alias("score")).groupBy("cycle", "base", "score").agg(F.count("*").alias("n"))


def cycle_quality(reads: DataFrame) -> DataFrame:
    """(cycle, reads, mean_quality, gc) over all reads."""
    n, known = F.sum("n"), F.sum(F.when(F.col("score").isNotNull(), F.col("n")))
    gc = F.sum(F.when(F.col("base").isin("G", "C"), F.col("n")).otherwise(0))
    return cycle_counts(reads).groupBy("cycle").agg(n.alias("reads"), (F.sum(F.col("score") * F.col("n")) / known).alias("mean_quality"), (gc / n).alias("gc"))


def cycle_percentiles(counts: DataFrame, percents: tuple[int, ...] = (10, 25, 50, 75, 90)) -> DataFrame:
    """(cycle, p10, ...) of cycle_counts(): at each cycle the least score that so many percent of the bases don't exceed."""
    by_score = counts.filter("score is not null").groupBy("cycle", "score").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("cycle")  # a row for each score
    ranked = by_score.withColumn("upto", F.sum("n").over(w.orderBy("score"))).withColumn("total", F.sum("n").over(w))
    return ranked.groupBy("cycle").agg(*[F.min(F.when(F.col("upto") * 100 >= F.col("total") * p, F.col("score"))).alias(f"p{p}") for p in percents])


def base_composition(counts: DataFrame) -> DataFrame:
    """(cycle, A, C, G, T, N, other) of cycle_counts(): the share of each base at each cycle."""
    total = F.sum("n")

    def share(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)) / total

    return counts.groupBy("cycle").agg(*[share(F.col("base") == b).alias(b) for b in LETTERS], share(~F.col("base").isin(*LETTERS)).alias("other"))


def length_histogram(reads: DataFrame) -> DataFrame:
    """(length, reads); a null read has length 0."""
    return reads.groupBy(F.coalesce(F.length("seq"), F.lit(0)).alias("length")).agg(F.count("*").alias("reads"))


def gc_histogram(reads: DataFrame) -> DataFrame:
    """(gc, reads): reads by their whole percent of G and C."""
    gc = F.length("seq") - F.length(F.translate("seq", "GC", ""))
    return reads.filter(F.length("seq") > 0).groupBy(F.floor(gc * 100 / F.length("seq")).cast("int").alias("gc")).agg(F.count("*").alias("reads"))


def read_quality_histogram(reads: DataFrame) -> DataFrame:
    """(quality, reads): reads by their mean quality, cut to a whole number."""
    scores = F.filter(F.split("qual", ""), lambda c: c != "")
    total = F.aggregate(scores, F.lit(0).cast("long"), lambda a, c: a + phred(c))
    return reads.filter(F.length("qual") > 0).groupBy(F.floor(total / F.size(scores)).cast("int").alias("quality")).agg(F.count("*").alias("reads"))


def heavy_hitters(rows: DataFrame, column: str, share: float, buckets: int = 1 << 20) -> DataFrame:
    """(column, n): all values that at least ``share`` of the rows with a value have, and how many have each.

    Rows are first counted in ``buckets`` by a hash: a frequent value's bucket is as frequent, and at most 1 / share
    buckets are. Only rows of those are then counted by value. So what is held grows neither with the rows nor with the
    number of different values, and the counts are exact.
    """
    known = rows.filter(F.col(column).isNotNull())
    bucket = F.pmod(F.xxhash64(column), F.lit(buckets))
    counted = stage(known.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")), "buckets")
    least = max(1, math.ceil(share * (counted.agg(F.sum("n")).first()[0] or 0)))
    frequent = counted.filter(F.col("n") >= least).select(F.col("bucket").alias("frequent"))  # 1 / share rows at most
    met = known.join(F.broadcast(frequent), bucket == F.col("frequent"))
    return met.groupBy(column).agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def overrepresented(reads: DataFrame, share: float = 0.001) -> DataFrame:
    """(seq, n, share): the sequences that are at least this share of all reads."""
    total = reads.filter("seq is not null").agg(F.count("*").alias("total"))  # one row
    return heavy_hitters(reads, "seq", share).join(F.broadcast(total)).select("seq", "n", (F.col("n") / F.col("total")).alias("share"))


def kmers(seq: Column, k: int) -> Column:
    """array<string>: the k letters from each place on."""
    letters = F.filter(F.split(seq, ""), lambda c: c != "")

    def at(x: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(x) - k), lambda i: F.concat(*[F.get(x, i + j) for j in range(k)]))
        return F.when(F.size(x) >= k, each).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(F.array(letters), at))  # letters are cut once


def kmer_enrichment(reads: DataFrame, k: int = 5, least: int = 1) -> DataFrame:
    """(kmer, n, cycle, at_cycle, ratio) of the k-mers of A, C, G, T found at least ``least`` times: the cycle at which a
    k-mer is most enriched (of equals the first), how often it begins there, and by what factor that is more than if it
    were spread as all k-mers are.

    Counts are added up by (k-mer, cycle) before the shuffle: 4^k k-mers at most for each cycle.
    """
    if not 1 <= k <= 10:
        raise ValueError("k is from 1 to 10")
    each = reads.filter(F.length("seq") >= k).select(F.posexplode(kmers(F.col("seq"), k)).alias("at", "kmer")).filter(F.col("kmer").rlike("^[ACGT]+$"))
    counted = stage(each.groupBy("kmer", (F.col("at") + 1).alias("cycle")).agg(F.count("*").alias("at_cycle")), "kmers")
    by_cycle = counted.groupBy(F.col("cycle").alias("c_cycle")).agg(F.sum("at_cycle").alias("all_at"))
    by_kmer = counted.groupBy(F.col("kmer").alias("k_kmer")).agg(F.sum("at_cycle").alias("n")).filter(F.col("n") >= least)
    total = counted.agg(F.sum("at_cycle").alias("total"))  # one row
    met = counted.join(by_kmer, F.col("kmer") == F.col("k_kmer")).join(by_cycle, F.col("cycle") == F.col("c_cycle")).join(F.broadcast(total))
    ratio = (F.col("at_cycle") / F.col("n")) / (F.col("all_at") / F.col("total"))
    best = met.groupBy("kmer", "n").agg(F.max(F.struct(ratio.alias("ratio"), (-F.col("cycle")).alias("before"), "at_cycle")).alias("best"))
    return best.select("kmer", "n", (-F.col("best.before")).alias("cycle"), "best.at_cycle", "best.ratio")
