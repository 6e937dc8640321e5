"""Bit vectors of aligned reads, and their merge for mates.

A vector is an array of (pos, bit), rising by position, made without a shuffle: as text, for a batch of reads at once
(functions.texts), and by array expressions within the row for the few reads that this leaves out. Packed fragments keep the
text: start and text, one symbol a position, have the vector wherever text isn't null, and bits elsewhere.
The reference table is the small side of the join; its size is left to Spark's own threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandframe.functions import texts
from strandframe.functions.columns import cigar_ops, deletion_is_ambiguous, phred, resolve_bits
from strandframe.functions.neighbours import together
from strandframe.model import AMBIGUOUS, BITS, DELETION, MATCH, MISSING, BitVectorConfig

#: Per cigar_mode: letters that are parsed; ops like M, like D, like I, without effect; others empty the vector.
_MODES = {"basic": ("[A-Z]", ("M",), ("D",), ("I",), ()), "sam": ("[A-Z=]", ("M", "=", "X"), ("D", "N"), ("I",), ("H", "P"))}


_FRAGMENT = ("qname", "rname", "sequence", "ref_length", "mapqs", "lengths", "seqs")


def placed_ops(cigar: Column, pos: Column, mode: str = "basic") -> Column:
    """array<struct<len,op,i,j,last>>: i, the reference position, and j, the number of read bases before each op."""
    letters, match, gap, extra, _ = _MODES[mode]
    ops = cigar_ops(cigar, letters)
    start = F.struct(F.size(ops).alias("n"), pos.cast("int").alias("i"), F.lit(0).alias("j"), F.array().cast("array<struct<len:int,op:string,i:int,j:int,last:boolean>>").alias("out"))

    def step(acc: Column, op: Column) -> Column:
        n, letter = op["len"], op["op"]
        last = F.size(acc["out"]) + 1 == acc["n"]
        di = F.when(letter.isin(*match, *gap) | ((letter == "S") & last), n).otherwise(0)
        dj = F.when(letter.isin(*match, *extra, "S"), n).otherwise(0)
        here = F.struct(n.alias("len"), letter.alias("op"), acc["i"].alias("i"), acc["j"].alias("j"), last.alias("last"))
        return F.struct(acc["n"].alias("n"), (acc["i"] + di).alias("i"), (acc["j"] + dj).alias("j"), F.concat(acc["out"], F.array(here)).alias("out"))

    return F.aggregate(ops, start, step, lambda acc: acc["out"])


def read_bits(cigar: Column, pos: Column, seq: Column, qual: Column, sequence: Column, config: BitVectorConfig = BitVectorConfig()) -> Column:
    """The vector of one read. A matched base beyond the reference's end has no bit."""
    _, match, gap, extra, silent = _MODES[config.cigar_mode]

    def bit(p: Column, b: Column) -> Column:
        return F.struct(p.cast("int").alias("pos"), b.alias("bit"))

    def of(op: Column) -> Column:
        n, i, j = op["len"], op["i"], op["j"]
        each = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))

        def letters(s: Column, start: Column) -> Column:
            return F.split(F.substr(s, start.cast("int"), n.cast("int")), "")

        def matched(x: Column, k: Column) -> Column:
            base, score, own = F.coalesce(x["base"], F.lit("")), F.coalesce(x["score"], F.lit("")), F.coalesce(x["own"], F.lit(""))
            called = F.when(base != own, base).otherwise(F.lit(MATCH))
            return bit(i + k, F.when(own == "", None).when(phred(score) > config.qscore_cutoff, called).otherwise(F.lit(AMBIGUOUS)))

        # each string is cut into letters once: a letter's place in a long string costs a walk from its start
        aligned = F.arrays_zip(letters(seq, j + 1).alias("base"), letters(qual, j + 1).alias("score"), letters(sequence, i).alias("own"))

        def deleted(k: Column) -> Column:
            sure = (k == n - 1) & ~deletion_is_ambiguous(sequence, i + n - 1, n, config.num_of_surbases)
            return bit(i + k, F.when(sure, F.lit(DELETION)).otherwise(F.lit(AMBIGUOUS)))

        clipped = F.transform(each, lambda k: bit(i + k, F.lit(MISSING)))
        letter = op["op"]
        return F.when(n == 0, F.array().cast(BITS)).when(letter.isin(*match), F.transform(aligned, matched)).when(letter.isin(*gap), F.transform(each, deleted)).when((letter == "S") & op["last"], clipped).otherwise(F.array().cast(BITS))

    ops = placed_ops(cigar, pos, config.cigar_mode)
    strange = F.exists(ops, lambda op: ~op["op"].isin(*match, *gap, *extra, *silent, "S"))
    return F.when(strange, F.array().cast(BITS)).otherwise(F.filter(F.flatten(F.transform(ops, of)), lambda b: b["bit"].isNotNull()))


def with_reference(reads: DataFrame, refs: DataFrame) -> DataFrame:
    """Reads with their reference's sequence and length; a read of an unknown reference is an error when it is met (leave
    such reads out first, by an anti-join with unknown_references(), if they may occur)."""
    known = reads.join(refs.select("rname", "sequence", F.length("sequence").alias("ref_length"), F.lit(True).alias("ref_known")), "rname", "left")
    met = F.when(F.col("ref_known"), True).otherwise(F.raise_error(F.concat(F.lit("read of an unknown reference: "), F.coalesce("rname", F.lit("(none)")))).cast("boolean"))
    return known.filter(met).drop("ref_known")


def unknown_references(reads: DataFrame, refs: DataFrame) -> DataFrame:
    return reads.join(refs.select("rname"), "rname", "left_anti")


def _once(df: DataFrame, name: str, value: Column, *columns: str) -> DataFrame:
    """The columns and value, as a generator's output: what uses it later doesn't evaluate the expression again."""
    return df.select(*columns, F.inline(F.array(F.struct(value.alias(name)))))


def _vector(known: DataFrame, config: BitVectorConfig, wanted: Column, read: str = "") -> tuple[DataFrame, Column]:
    """known with the text of the vectors of wanted reads (columns behind the prefix read), and what their arrays are where
    there is no text."""
    cells = [F.col(f"{read}{c}") for c in ("cigar", "pos", "seq", "qual")]
    text = texts.vector_text(F.when(wanted, cells[0]), *cells[1:], F.col("sequence"), _MODES[config.cigar_mode], config.qscore_cutoff, config.num_of_surbases)
    return known.withColumn("text", text), F.when(wanted & F.col("text").isNull(), read_bits(*cells, F.col("sequence"), config))


def single_fragments(reads: DataFrame, refs: DataFrame, config: BitVectorConfig = BitVectorConfig(), lazy: bool = False, packed: bool = False) -> DataFrame:
    """(qname, rname, sequence, ref_length, mapqs, lengths, seqs, bits): one row for each read.

    lazy: a read whose mapping quality is too low has no vector (null), for counts that don't look at rejected ones.
    packed: also start and text, and bits is null where these have the vector.
    """
    wanted = F.col("mapq") >= config.map_score_cutoff if lazy else F.lit(True)
    known, arrays = _vector(with_reference(reads, refs), config, wanted)
    known = known.withColumn("mapqs", F.array("mapq")).withColumn("lengths", F.array(F.length("seq"))).withColumn("seqs", F.array("seq"))
    if packed:
        return known.select(*_FRAGMENT, arrays.alias("bits"), F.col("pos").alias("start"), "text")
    return _once(known, "bits", F.when(F.col("text").isNotNull(), texts.bits_of(F.col("text"), F.col("pos"))).otherwise(arrays), *_FRAGMENT)


def _agree() -> Column:
    return (F.col("r1.pnext") == F.col("r2.pos")) & (F.col("r1.rname") == F.col("r2.rname")) & (F.col("r1.rnext") == "=") & (F.col("r1.mapq") == F.col("r2.mapq"))


def is_primary(reads: DataFrame) -> Column:
    """Whether a line is neither secondary nor supplementary; true for all, if reads have no flags."""
    return F.col("flag").cast("int").bitwiseAND(0x900) == 0 if "flag" in reads.columns else F.lit(True)


def fragments_by_name(reads: DataFrame, mate_col: str = "mate") -> DataFrame:
    """(qname, r1, r2, n1, n2): the two mates of each query name (null: missing) and how many lines each has. One
    shuffle, in which each read moves once."""
    read = F.struct(*[c for c in reads.columns if c != mate_col])
    sides = [F.first(F.when(F.col(mate_col) == m, read), ignorenulls=True).alias(f"r{m}") for m in (1, 2)]
    return reads.filter(is_primary(reads)).groupBy("qname").agg(*sides, *[F.count_if(F.col(mate_col) == m).alias(f"n{m}") for m in (1, 2)])


def pairs_of(fragments: DataFrame) -> DataFrame:
    """(qname, rname, r1, r2) of fragments_by_name()'s names with one line for each mate, which agree on each other's place,
    the reference and the mapping quality."""
    return fragments.filter((F.col("n1") == 1) & (F.col("n2") == 1) & _agree()).select("qname", F.col("r1.rname").alias("rname"), "r1", "r2")


def orphans_of(fragments: DataFrame) -> DataFrame:
    """The only lines of fragments_by_name()'s names, as single reads."""
    return fragments.filter((F.col("n1") + F.col("n2")) == 1).select(F.coalesce("r1", "r2").alias("r")).select("r.*")


def consistent_pairs(reads: DataFrame, mate_col: str = "mate") -> DataFrame:
    """(qname, rname, r1, r2) of the pairs, by query name, that agree on each other's place, the reference and the
    mapping quality. A name with more than one line for a mate is no pair."""
    return pairs_of(fragments_by_name(reads, mate_col))


def orphans(reads: DataFrame, mate_col: str = "mate") -> DataFrame:
    """The reads whose mate is missing, as single reads."""
    return orphans_of(fragments_by_name(reads, mate_col))


def positional_pairs(reads: DataFrame) -> DataFrame:
    """(qname, rname, r1, r2) of reads (file, number, and an aligned read's columns) paired by their place: numbers 2k
    and 2k + 1 of a file, kept if they agree, also on the query name.

    Reads that are whole (a column of numbered_sam(): the two follow each other in a task) are paired where they are; only
    the others are shuffled, or all, if there is no such column."""
    read = F.struct(*[c for c in reads.columns if c not in ("file", "number", "whole")]).alias("read")
    sides = [F.first(F.when(F.col("number") % 2 == m, F.col("read")), ignorenulls=True).alias(f"r{m + 1}") for m in (0, 1)]
    near = "whole" in reads.columns
    apart = (reads.filter("not whole") if near else reads).select("file", "number", read)
    pairs = apart.groupBy("file", F.floor(F.col("number") / 2).alias("record")).agg(*sides)
    if near:
        pairs = together(reads.filter("whole").select("file", "number", read), 2, "read", ["r1", "r2"]).unionByName(pairs)
    return pairs.filter(_agree() & (F.col("r1.qname") == F.col("r2.qname"))).select(F.col("r1.qname").alias("qname"), F.col("r1.rname").alias("rname"), "r1", "r2")


def merge_bits(a: Column, b: Column) -> Column:
    """The vector of two mates' vectors: all positions of both, conflicts resolved, rising by position."""
    merged = F.map_zip_with(F.map_from_entries(a), F.map_from_entries(b), lambda _, x, y: resolve_bits(x, y))
    return F.array_sort(F.transform(F.map_entries(merged), lambda e: F.struct(e["key"].alias("pos"), e["value"].alias("bit"))))


def paired_fragments(pairs: DataFrame, refs: DataFrame, config: BitVectorConfig = BitVectorConfig()) -> DataFrame:
    """As single_fragments, one row for each pair of consistent_pairs()."""
    known = with_reference(pairs, refs)
    one, two = (read_bits(*(F.col(f"r{m}.{c}") for c in ("cigar", "pos", "seq", "qual")), F.col("sequence"), config) for m in (1, 2))
    known = known.withColumn("mapqs", F.array("r1.mapq", "r2.mapq")).withColumn("lengths", F.array(F.length("r1.seq"), F.length("r2.seq"))).withColumn("seqs", F.array("r1.seq", "r2.seq"))
    return _once(known, "bits", merge_bits(one, two), *_FRAGMENT)


def packed_pair_fragments(reads: DataFrame, refs: DataFrame, config: BitVectorConfig = BitVectorConfig(), mate_col: str = "mate") -> DataFrame:
    """paired_fragments() of consistent_pairs(), packed, without sequence and seqs: (qname, rname, ref_length, mapqs, lengths,
    bits, start, text).

    Each mate's vector is made before the mates meet, and moves as text instead of bases and qualities; a read whose mapping
    quality is too low has none, so such a pair has no vector (null). A pair of an unknown reference is an error.
    """
    wanted = F.col("mapq") >= config.map_score_cutoff
    known = reads.join(refs.select("rname", "sequence", F.length("sequence").alias("ref_length"), F.lit(True).alias("ref_known")), "rname", "left")
    made, arrays = _vector(known, config, wanted & F.col("ref_known"))
    flag = ["flag"] if "flag" in reads.columns else []
    mates = made.select("qname", *flag, "rname", "pos", "mapq", "rnext", "pnext", mate_col, "ref_known", "ref_length", F.length("seq").alias("n"), "text", arrays.alias("bits"))
    pairs = pairs_of(fragments_by_name(mates, mate_col))
    met = F.when(F.col("r1.ref_known"), True).otherwise(F.raise_error(F.concat(F.lit("read of an unknown reference: "), F.coalesce("rname", F.lit("(none)")))).cast("boolean"))
    sides = [F.col(f"r{m}.{c}") for m in (1, 2) for c in ("pos", "text")]
    merged = pairs.filter(met).select("qname", "rname", "r1", "r2", texts.merged_text(*sides).alias("text"))
    one, two = (F.coalesce(texts.bits_of(F.col(f"r{m}.text"), F.col(f"r{m}.pos")), f"r{m}.bits") for m in (1, 2))
    return merged.select(
        "qname", "rname", F.col("r1.ref_length").alias("ref_length"), F.array("r1.mapq", "r2.mapq").alias("mapqs"), F.array("r1.n", "r2.n").alias("lengths"),
        F.when(F.col("text").isNull(), merge_bits(one, two)).alias("bits"), texts.merged_start(*sides).alias("start"), "text",
    )
