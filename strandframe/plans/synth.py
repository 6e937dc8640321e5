"""References, reads and mates derived from the tables part and lineitem, for queries over those tables.

A reference of 64 bases is made of each part's key; a pair of reads of each line of an order, with one of eight CIGAR
shapes each, up to three changed bases, and qualities on both sides of the usual cutoff.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEX, DNA, QUALITIES = "0123456789abcdef", "ACGTACGTACGTACGT", "5:;>?@ABCDEFGHIJ"
FILLER = "ACGTTGCAACGTTGCAACGT"


@dataclass(frozen=True)
class Shape:
    """A CIGAR and where a read of it gets its bases: (reference offset or None for filler, bases)."""

    cigar: str
    parts: tuple[tuple[int | None, int], ...]

    @property
    def bases(self) -> int:
        return sum(n for _, n in self.parts)


SHAPES = (
    Shape("40M", ((0, 40),)),
    Shape("20M1D19M", ((0, 20), (21, 19))),
    Shape("18M2I20M4S", ((0, 18), (None, 2), (18, 20), (None, 4))),
    Shape("3S30M", ((None, 3), (0, 30))),
    Shape("15M3D20M2S", ((0, 15), (18, 20), (None, 2))),
    Shape("10M5N10M", ((0, 10), (15, 10))),
    Shape("10=20M", ((0, 30),)),
    Shape("45M12S", ((0, 45), (None, 12))),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _concat_md5(first: str, second: str, key: str) -> Column:
    return F.concat(*[F.md5(F.concat(F.lit(x), F.col(key).cast("string"))) for x in (first, second)])


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rname, sequence)."""
    part = _table(spark, sf_dir, "part").select("p_partkey")
    return part.select(F.concat(F.lit("ref_"), F.col("p_partkey").cast("string")).alias("rname"), F.translate(_concat_md5("a", "b", "p_partkey"), HEX, DNA).alias("sequence"))


def structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, sequence, structure) of the references with an even key."""
    part = _table(spark, sf_dir, "part").select("p_partkey").filter("p_partkey % 2 = 0")
    return part.select(
        F.concat(F.lit("ref_"), F.col("p_partkey").cast("string")).alias("name"), F.translate(_concat_md5("a", "b", "p_partkey"), HEX, DNA).alias("sequence"),
        F.translate(_concat_md5("c", "d", "p_partkey"), HEX, "....((((....))))").alias("structure"),
    )


def _evaluated(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is a generator's output, so that its expression isn't repeated in each of its uses."""
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def _changed(seq: Column, at: Column, when: Column) -> Column:
    place = F.pmod(at, F.length(seq)).cast("int")
    new = F.concat(F.substr(seq, F.lit(1), place), F.translate(F.substr(seq, place + 1, F.lit(1)), "ACGT", "CGTA"), F.substr(seq, place + 2, F.length(seq)))
    return F.when(when, new).otherwise(seq)


def mates(spark: SparkSession, sf_dir: str, gathered: bool = False) -> DataFrame:
    """The aligned reads of both mates, with mate 1 or 2 and key, the name of the pair.

    gathered: those of a reference are made in one task, of lines that were brought together.
    """
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    name = F.concat(F.lit("ref_"), F.col("l_partkey").cast("string"))
    if gathered:  # lines are a small part of the reads that are made of them
        lines = lines.repartition(name)
    elif lines.rdd.getNumPartitions() < (cores := spark.sparkContext.defaultParallelism):  # few small splits, each much work
        lines = lines.repartition(cores)
    lines = lines.join(references(spark, sf_dir), name == F.col("rname"))
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    lines = lines.withColumn("key", key)
    sides = F.explode(F.array(F.lit(1), F.lit(2))).alias("mate")
    m = lines.select("*", sides)
    m = m.withColumn("shape", F.pmod(F.col("l_orderkey") + F.col("l_linenumber") + (F.col("mate") - 1) * 3, F.lit(8)).cast("int"))
    first = (F.pmod(F.col("l_suppkey") + F.col("l_linenumber"), F.lit(12)) + 1).cast("int")
    second = (F.pmod(first + 5, F.lit(12)) + 1).cast("int")
    m = m.withColumn("pos", F.when(F.col("mate") == 1, first).otherwise(second)).withColumn("other", F.when(F.col("mate") == 1, second).otherwise(first))

    def raw(shape: Shape) -> Column:
        return F.concat(*[F.lit(FILLER[:n]) if at is None else F.substr("sequence", F.col("pos") + at, F.lit(n)) for at, n in shape.parts])

    def by_shape(value) -> Column:
        out = F.when(F.col("shape") == 0, value(SHAPES[0]))
        for i, s in enumerate(SHAPES[1:], 1):
            out = out.when(F.col("shape") == i, value(s))
        return out

    m = _evaluated(m.withColumn("changes", F.pmod(F.floor(F.col("l_orderkey") / 8) + F.col("l_linenumber") + F.col("mate"), F.lit(4))), "seq0", by_shape(raw))
    for n, at in enumerate((F.col("l_partkey"), F.col("l_partkey") * 7 + F.col("l_suppkey"), F.col("l_suppkey") + F.col("mate")), 1):
        m = _evaluated(m, f"seq{n}", _changed(F.col(f"seq{n - 1}"), at, F.col("changes") >= n))
    m = m.withColumnRenamed("seq3", "seq")
    quality = F.when(F.col("mate") == 1, _concat_md5("q", "r", "key")).otherwise(_concat_md5("s", "t", "key"))
    lower = F.when((F.col("mate") == 2) & (F.pmod("l_linenumber", F.lit(5)) == 0), 1).otherwise(0)
    return m.select(
        F.col("key").alias("qname"), F.when(F.col("mate") == 1, "67").otherwise("131").alias("flag"), "rname", "pos",
        (F.pmod("l_orderkey", F.lit(45)) - lower).cast("int").alias("mapq"), by_shape(lambda s: F.lit(s.cigar)).alias("cigar"), F.lit("=").alias("rnext"),
        (F.col("other") + F.when((F.col("mate") == 1) & (F.pmod("l_orderkey", F.lit(11)) == 0), 1).otherwise(0)).cast("int").alias("pnext"), F.lit(0).alias("tlen"), "seq",
        F.substr(F.translate(quality, HEX, QUALITIES), F.lit(1), F.length("seq")).alias("qual"), F.lit("").alias("md_string"), "mate", "key",
    )


def reads(spark: SparkSession, sf_dir: str, gathered: bool = False) -> DataFrame:
    """The first mates, as single reads; gathered: as in mates()."""
    return mates(spark, sf_dir, gathered).filter("mate = 1")


def _sql_by_shape(value) -> str:
    return "CASE shape " + " ".join(f"WHEN {i} THEN {value(s)}" for i, s in enumerate(SHAPES)) + " END"


def _sql_changed(seq: str, at: str, when: str) -> str:
    place = f"(({at}) % length({seq}))"
    return f"CASE WHEN {when} THEN concat(substr({seq}, 1, {place}), translate(substr({seq}, {place} + 1, 1), 'ACGT', 'CGTA'), substr({seq}, {place} + 2)) ELSE {seq} END"


#: DuckDB SQL (common table expressions) of the same tables: refs, structures and mates. Here key tells repeated lines apart.
SQL = f"""
refs AS (SELECT concat('ref_', p_partkey) AS rname, translate(concat(md5(concat('a', p_partkey)), md5(concat('b', p_partkey))), '{HEX}', '{DNA}') AS sequence FROM part),
structures AS (SELECT concat('ref_', p_partkey) AS name, translate(concat(md5(concat('c', p_partkey)), md5(concat('d', p_partkey))), '{HEX}', '....((((....))))') AS structure FROM part WHERE p_partkey % 2 = 0),
lines AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, concat(l_orderkey, ':', l_linenumber, ':', l_partkey, ':', l_suppkey) AS key,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS copy, rname, sequence, (l_suppkey + l_linenumber) % 12 + 1 AS p1 FROM lineitem JOIN refs ON rname = concat('ref_', l_partkey)),
sides AS (SELECT *, (l_orderkey + l_linenumber + (mate - 1) * 3) % 8 AS shape, CASE mate WHEN 1 THEN p1 ELSE (p1 + 5) % 12 + 1 END AS pos, CASE mate WHEN 2 THEN p1 ELSE (p1 + 5) % 12 + 1 END AS other,
  (l_orderkey // 8 + l_linenumber + mate) % 4 AS changes FROM lines, (SELECT unnest([1, 2]) AS mate)),
raw0 AS (SELECT *, {_sql_by_shape(lambda s: "concat(" + ", ".join(f"'{FILLER[:n]}'" if at is None else f"substr(sequence, pos + {at}, {n})" for at, n in s.parts) + ")")} AS s0 FROM sides),
raw1 AS (SELECT *, {_sql_changed("s0", "l_partkey", "changes >= 1")} AS s1 FROM raw0),
raw2 AS (SELECT *, {_sql_changed("s1", "l_partkey * 7 + l_suppkey", "changes >= 2")} AS s2 FROM raw1),
raw3 AS (SELECT *, {_sql_changed("s2", "l_suppkey + mate", "changes >= 3")} AS seq FROM raw2),
mates AS (SELECT key AS qname, CASE mate WHEN 1 THEN '67' ELSE '131' END AS flag, rname, pos::INT AS pos,
  (l_orderkey % 45 - CASE WHEN mate = 2 AND l_linenumber % 5 = 0 THEN 1 ELSE 0 END)::INT AS mapq, {_sql_by_shape(lambda s: f"'{s.cigar}'")} AS cigar, '=' AS rnext,
  (other + CASE WHEN mate = 1 AND l_orderkey % 11 = 0 THEN 1 ELSE 0 END)::INT AS pnext, seq,
  substr(translate(CASE mate WHEN 1 THEN concat(md5(concat('q', key)), md5(concat('r', key))) ELSE concat(md5(concat('s', key)), md5(concat('t', key))) END, '{HEX}', '{QUALITIES}'), 1, length(seq)) AS qual, mate, concat(key, '#', copy) AS key, sequence
  FROM raw3)
"""
