"""Which fragments count: the first filter that fails names the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandframe.functions import texts
from strandframe.functions.columns import is_base
from strandframe.model import BASES, BitVectorConfig


def mutation_positions(bits: Column) -> Column:
    return F.transform(F.filter(bits, lambda b: is_base(b["bit"])), lambda b: b["pos"])


def mutation_count(bits: Column, ref_length: Column) -> Column:
    return F.size(F.filter(bits, lambda b: is_base(b["bit"]) & (b["pos"] >= 1) & (b["pos"] <= ref_length)))


def closer_than(positions: Column, distance: int) -> Column:
    """Whether two of the rising positions are at most so far apart."""
    n = F.size(positions)
    gaps = F.zip_with(F.slice(positions, 2, F.greatest(n - 1, F.lit(0))), F.slice(positions, 1, F.greatest(n - 1, F.lit(0))), lambda y, x: y - x)
    return F.exists(gaps, lambda d: d <= distance)


def reason(config: BitVectorConfig, mutated: Column) -> Column:
    """Null for a fragment that counts. mutated: its mutations' positions."""
    out = F.when(F.exists("mapqs", lambda q: q < config.map_score_cutoff), F.lit("low_mapq"))
    if s := config.stricter:
        out = out.when(F.exists("lengths", lambda n: n / F.col("ref_length") < s.percent_length_cutoff), F.lit("short_read"))
        out = out.when(F.col("n_mut") > s.mutation_count_cutoff, F.lit("too_many_muts"))
        out = out.when(closer_than(mutated, s.min_mut_distance), F.lit("muts_too_close"))
    return out


def with_reason(fragments: DataFrame, config: BitVectorConfig = BitVectorConfig()) -> DataFrame:
    """Fragments with n_mut and reason.

    Without stricter filters the reason doesn't look at the vector, so a fragment of low quality is left out before its
    vector is made, where only accepted ones are asked for. With them the vector is gone through once, for the positions
    that both the number and the distances need. Packed fragments stay packed.
    """
    bits, packed = F.col("bits"), "text" in fragments.columns
    if config.stricter is None:
        number = mutation_count(bits, F.col("ref_length"))
        if packed:
            within = texts.inside(F.col("text"), F.col("start"), F.col("ref_length"))
            number = F.when(F.col("text").isNotNull(), texts.count_of(within, "".join(BASES))).otherwise(number)
        return fragments.withColumn("n_mut", number).withColumn("reason", reason(config, mutation_positions(bits)))
    if packed:
        bits = F.coalesce(texts.bits_of(F.col("text"), F.col("start")), bits)
    known = fragments.select("*", F.inline(F.array(F.struct(mutation_positions(bits).alias("mutated")))))
    inside = F.size(F.filter("mutated", lambda p: (p >= 1) & (p <= F.col("ref_length"))))
    return known.withColumn("n_mut", inside).withColumn("reason", reason(config, F.col("mutated"))).drop("mutated")


def rejected(judged: DataFrame) -> DataFrame:
    """The rejected fragments, with their reads (no second one: empty) and the vector as text."""
    from strandframe.operators.render import dense_text

    reads = [F.coalesce(F.get("seqs", i), F.lit("")).alias(f"read{i + 1}") for i in (0, 1)]
    return judged.filter(F.col("reason").isNotNull()).select("qname", "rname", "reason", *reads, dense_text(F.col("bits"), F.lit(1), F.col("ref_length")).alias("bitvector"))
