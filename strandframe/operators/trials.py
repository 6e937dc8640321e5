"""Which parameter values the best trials of a search share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METRICS = ("trial", "quality_score", "signal_to_noise", "alignment_rate", "avg_mapq", "bv_accepted")


def top(trials: DataFrame, n: int) -> DataFrame:
    """The n best of the trials that succeeded (score above 0); ties go to the first trial."""
    return trials.filter("quality_score > 0").orderBy(F.desc("quality_score"), "trial").limit(n)


def long(trials: DataFrame) -> DataFrame:
    """(trial, quality_score, param, value) of all but the metric columns; nulls are left out."""
    params = [c for c in trials.columns if c not in METRICS]
    cells = F.explode(F.array(*[F.struct(F.lit(p).alias("param"), F.col(p).cast("string").alias("value")) for p in params]))
    return trials.select("trial", "quality_score", cells.alias("x")).select("trial", "quality_score", "x.*").filter("value is not null")


def frequency(cells: DataFrame) -> DataFrame:
    """(param, value, n, frequency, first_seen)."""
    counted = cells.groupBy("param", "value").agg(F.count("*").alias("n"), F.min(F.struct((-F.col("quality_score")).alias("q"), "trial")).alias("first_seen"))
    return counted.withColumn("frequency", F.col("n") / F.sum("n").over(Window.partitionBy("param")))


def modes(frequencies: DataFrame) -> DataFrame:
    """(param, value, most_common_frequency, unique_values): the commonest value, the first seen of equals."""
    w = Window.partitionBy("param")
    ranked = frequencies.withColumn("r", F.row_number().over(w.orderBy(F.desc("n"), "first_seen"))).withColumn("unique_values", F.count("*").over(w))
    return ranked.filter("r = 1").select("param", "value", F.col("frequency").alias("most_common_frequency"), "unique_values")


def classes(modes_: DataFrame, min_frequency: float = 0.5) -> DataFrame:
    """(class, params): how many parameters are constant, of high frequency, or variable."""
    f = F.col("most_common_frequency")
    return modes_.select(F.when(f == 1, "constant").when(f >= min_frequency, "high").otherwise("variable").alias("class")).groupBy("class").agg(F.count("*").alias("params"))


def score_stats(best: DataFrame) -> DataFrame:
    q = "quality_score"
    return best.agg(F.min(q).alias("min_score"), F.max(q).alias("max_score"), F.round(F.avg(q), 6).alias("mean_score"), F.median(q).alias("median_score"))
