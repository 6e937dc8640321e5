"""Mutation histograms as long tables, their merge and what is derived from them.

``positions`` (rname, pos, cov, info, mut, del, ins, A, C, G, T), ``mutation_counts`` (rname, n_mut, reads) and
``read_counts`` (rname, num_reads, num_aligned, one column for each reason) are sums by key, partially aggregated
before the shuffle; so one reference may hold all reads, and tables of parts merge by adding up.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandframe.functions import texts
from strandframe.functions.columns import half_even, is_base, ratio
from strandframe.model import ABSENT, AMBIGUOUS, BASES, DELETION, MATCH, REASONS, InputError
from strandframe.operators.render import dense_inside

SUMS = ("cov", "info", "mut", "del", "ins", *BASES)


def _count(condition: Column) -> Column:
    return F.sum(condition.cast("int")).cast("long")


def _symbol_counts() -> list[Column]:
    bit = F.col("bit")
    return [
        _count(bit != AMBIGUOUS).alias("cov"), F.count("bit").alias("info"), _count(is_base(bit)).alias("mut"), _count(bit == DELETION).alias("del"), F.lit(0).cast("long").alias("ins"), *[_count(bit == b).alias(b) for b in BASES],
    ]


def _packed(judged: DataFrame, *columns: str | Column) -> DataFrame:
    """(columns, start, text): each accepted fragment's symbols within its reference as text, from position start on, and
    null for a rejected one; rows are gathered by reference.

    A text is a small part of the rows of counts that it makes, and where the fragments of a reference are together, most
    of those add up before they move. Where counts by reference follow, Spark counts a reference's texts in one task.
    """
    has_text = "text" in judged.columns
    own = [F.when(F.col("reason").isNull(), F.col("start")).alias("own_start"), F.when(F.col("reason").isNull(), texts.inside(F.col("text"), F.col("start"), F.col("ref_length"))).alias("own_text")] if has_text else []
    raw = judged.select(*columns, "rname", "bits", "ref_length", "reason", *own, F.inline(F.array(F.struct(F.when(F.col("reason").isNull(), F.array_join(F.col("bits")["bit"], "")).alias("raw")))))
    n, first, last = F.size("bits"), F.try_element_at("bits", F.lit(1))["pos"], F.try_element_at("bits", F.lit(-1))["pos"]
    lo, hi = F.greatest(first, F.lit(1)), F.least(last, F.col("ref_length"))
    plain = (last - first + 1 == n) & (F.length("raw") == n)  # no gaps, and one letter a symbol
    cut = F.struct(lo.alias("start"), F.when(hi >= lo, F.substr(F.translate("raw", ABSENT, MATCH), lo - first + 1, hi - lo + 1)).alias("text"))
    kept = [c for c in raw.columns if c not in ("bits", "ref_length", "reason", "own_start", "own_text", "raw")]
    packed = F.when(F.col("raw").isNull() | (n == 0), F.lit(None)).when(plain, cut).otherwise(_looked_up(F.col("bits"), F.col("ref_length")))
    if has_text:
        known = F.col("own_text").isNotNull()
        return raw.select(*kept, *[F.when(known, F.col(f"own_{c}")).otherwise(packed[c]).alias(c) for c in ("start", "text")]).hint("rebalance", "rname")
    return raw.select(*kept, packed.alias("p")).select(*kept, "p.start", "p.text").hint("rebalance", "rname")


def _looked_up(bits: Column, ref_length: Column) -> Column:
    """_packed()'s start and text of a vector with gaps, or with symbols that aren't one letter (they count as a match)."""
    known = (AMBIGUOUS, DELETION, *BASES)
    inside = F.filter(bits, lambda b: b["bit"].isNotNull() & (b["pos"] >= 1) & (b["pos"] <= ref_length))
    letters = F.transform(inside, lambda b: F.struct(b["pos"].alias("pos"), F.when(b["bit"].isin(*known), b["bit"]).otherwise(MATCH).alias("bit")))

    def pack(v: Column) -> Column:
        first, last = F.try_element_at(v, F.lit(1))["pos"], F.try_element_at(v, F.lit(-1))["pos"]
        return F.struct(first.alias("start"), F.when(F.size(v) > 0, dense_inside(v, first, last)).alias("text"))

    return F.element_at(F.transform(F.array(letters), pack), 1)


def positions(judged: DataFrame, *by: str) -> DataFrame:
    """Counts at each position that an accepted fragment covers. cov leaves ambiguous symbols out, info takes all.

    by: columns of judged (such as a part's number) by which the counts are kept apart.
    """
    packed = _packed(judged.filter(F.col("reason").isNull()), *by)
    each = packed.select(*by, "rname", "start", F.posexplode(F.split("text", "")).alias("at", "bit")).filter(~F.col("bit").isin("", ABSENT))
    return each.select(*by, "rname", (F.col("start") + F.col("at")).alias("pos"), "bit").groupBy(*by, "rname", "pos").agg(*_symbol_counts())


#: The place of the entry that stands for the fragment itself.
_SELF = -(1 << 31)


def tallies(judged: DataFrame, *by: str) -> DataFrame:
    """All counts in one pass: (rname, pos, n_mut, reason, the sums, reads); a row has either a position and its sums,
    or a number of mutations, a reason and the number of such fragments. of_positions(), of_mutations() and of_reads()
    read the three tables off it.

    A fragment's text gets one more entry, which stands for itself: its symbol is the number of mutations and the
    reason. A rejected fragment has that entry only, and needs no vector (then it counts as one of -1 mutations).
    """
    tag = F.concat_ws(" ", F.coalesce("n_mut", F.lit(-1)).cast("string"), "reason").alias("own")
    packed = _packed(judged, *by, tag)
    own = F.array("own")
    each = packed.select(*by, "rname", "start", F.posexplode(F.when(F.col("text").isNull(), own).otherwise(F.concat(own, F.split("text", "")))).alias("at", "bit")).filter(~F.col("bit").isin("", ABSENT))
    is_own = F.col("at") == 0
    split = each.select(*by, "rname", F.when(is_own, _SELF).otherwise(F.col("start") + F.col("at") - 1).alias("pos"), F.when(is_own, F.col("bit")).alias("tag"), F.when(~is_own, F.col("bit")).alias("bit"))
    counted = split.groupBy(*by, "rname", "pos", "tag").agg(*_symbol_counts(), F.count("tag").alias("reads"))
    parts = F.split("tag", " ")
    return counted.select(*by, "rname", F.nullif("pos", F.lit(_SELF)).alias("pos"), F.get(parts, 0).cast("int").alias("n_mut"), F.get(parts, 1).alias("reason"), *SUMS, "reads")


def fragment_counts(judged: DataFrame, *by: str) -> DataFrame:
    """tallies() without the rows of positions, for what is read off by of_mutations() and of_reads() alone."""
    return judged.groupBy(*by, "rname", F.coalesce("n_mut", F.lit(-1)).alias("n_mut"), "reason").agg(F.count("*").alias("reads"))


def of_positions(tallied: DataFrame) -> DataFrame:
    """positions() of tallies()."""
    return tallied.filter("pos is not null").drop("n_mut", "reason", "reads")


def of_mutations(tallied: DataFrame) -> DataFrame:
    """mutation_counts() of tallies()."""
    return tallied.filter("n_mut is not null and reason is null").select("rname", "n_mut", "reads")


def _read_sums(own: Column) -> list[Column]:
    """The columns of read_counts() of tallies()' rows for which own holds."""

    def reads(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(own & condition, F.col("reads"))), F.lit(0)).cast("long")

    return [reads(F.lit(True)).alias("num_reads"), reads(F.col("reason").isNull()).alias("num_aligned"), *[reads(F.col("reason") == r).alias(r) for r in REASONS]]


def of_reads(tallied: DataFrame) -> DataFrame:
    """read_counts() of tallies()."""
    return tallied.filter("n_mut is not null").groupBy("rname").agg(*_read_sums(F.lit(True)))


def mutation_counts(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNull()).groupBy("rname", "n_mut").agg(F.count("*").alias("reads"))


def read_counts(judged: DataFrame) -> DataFrame:
    return judged.groupBy("rname").agg(F.count("*").alias("num_reads"), _count(F.col("reason").isNull()).alias("num_aligned"), *[_count(F.coalesce(F.col("reason") == r, F.lit(False))).alias(r) for r in REASONS])


def with_all_references(counts: DataFrame, refs: DataFrame) -> DataFrame:
    """read_counts with a row of zeros for each reference without reads."""
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts.columns if c != "rname"]
    return refs.select("rname").join(counts, "rname", "left").select("rname", *zero)


#: Positions of a reference that are held as one array at most.
BLOCK = 1024


def dense_blocks(pos: DataFrame, refs: DataFrame, *by: str, sums: tuple[str, ...] = SUMS) -> DataFrame:
    """(by, rname, block, each): positions() of every reference by blocks of BLOCK positions, each an array of structs (pos,
    nuc, the sums) that rises by position, with zeros where nothing is known.

    Known counts move once, as rows by block; references join as pieces of their sequence, not as positions.
    by: columns of both by which tables are kept apart. sums: those that are asked for; others don't move.
    """
    block = F.floor((F.col("pos") - 1) / BLOCK).cast("int")
    known = pos.groupBy(*by, "rname", block.alias("block")).agg(F.collect_list(F.struct(F.col("pos").cast("int").alias("pos"), *sums)).alias("known"))  # BLOCK positions
    starts = F.sequence(F.lit(0), F.floor((F.length("sequence") - 1) / BLOCK).cast("int"))
    pieces = refs.filter(F.length("sequence") > 0).select(*by, "rname", "sequence", F.explode(starts).alias("block"))
    pieces = pieces.select(*by, "rname", "block", F.filter(F.split(F.substr("sequence", F.col("block") * BLOCK + 1, F.lit(BLOCK)), ""), lambda c: c != "").alias("nucs"))
    own = pieces.join(known, [*by, "rname", "block"], "left")
    first, n = F.col("block") * BLOCK + 1, F.size("nucs")
    inside = F.filter(F.coalesce("known", F.array().cast(known.schema["known"].dataType)), lambda s: (s["pos"] >= first) & (s["pos"] < first + n))
    lacking = F.array_except(F.sequence(first, first + n - 1), F.transform(inside, lambda s: s["pos"]))
    zero = [F.lit(0).cast("long").alias(c) for c in sums]
    every = F.array_sort(F.concat(inside, F.transform(lacking, lambda p: F.struct(p.alias("pos"), *zero))))
    return own.select(*by, "rname", "block", F.transform(every, lambda s: F.struct(s["pos"].alias("pos"), F.get("nucs", s["pos"] - first).alias("nuc"), *[F.coalesce(s[c], F.lit(0).cast("long")).alias(c) for c in sums])).alias("each"))


def dense_positions(pos: DataFrame, refs: DataFrame, sums: tuple[str, ...] = SUMS) -> DataFrame:
    """positions with a row for every position of every reference, and its nucleotide; sums: those that are asked for."""
    return dense_blocks(pos, refs, sums=sums).select("rname", F.inline("each")).select("rname", "pos", "nuc", *sums)


def dense_series(pos: DataFrame, refs: DataFrame, *by: str) -> DataFrame:
    """(by, rname, series): all dense_blocks() of a reference as one array; no row for an empty sequence."""
    blocks = dense_blocks(pos, refs, *by)
    ordered = F.array_sort(F.collect_list(F.struct("block", "each")))
    return blocks.groupBy(*by, "rname").agg(F.flatten(F.transform(ordered, lambda b: b["each"])).alias("series"))


def gathered(tallied: DataFrame, *by: str) -> DataFrame:
    """(by, rname, known, by_n, the columns of read_counts()): tallies() of a reference in a row. known: its positions, as
    structs in any order; by_n: its accepted fragments by number of mutations."""
    at, own = F.col("pos").isNotNull(), F.col("n_mut").isNotNull()
    known = F.collect_list(F.when(at, F.struct(F.col("pos").cast("int").alias("pos"), *SUMS))).alias("known")
    by_n = F.map_from_entries(F.collect_list(F.when(own & F.col("reason").isNull(), F.struct("n_mut", "reads")))).alias("by_n")
    return tallied.groupBy(*by, "rname").agg(known, by_n, *_read_sums(own))


#: Positions whose series go to the JVM at once, about.
SERIES = 1 << 17


def with_series(rows: DataFrame, length: str, sums: tuple[str, ...] = SUMS) -> DataFrame:
    """rows, of a reference each, with an array of doubles for each of the sums instead of known (as in gathered(), or null):
    the value of position p in slot p, 0 where nothing is known and in slot 0."""
    kept = [f for f in rows.schema.fields if f.name != "known"]
    kind = T.StructType([*kept, *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in sums]])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            long = np.cumsum(batch[length].to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            cuts = np.unique(np.concatenate([[0], np.searchsorted(long, np.arange(SERIES, long[-1], SERIES)) + 1, [batch.num_rows]])) if batch.num_rows else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(a, b - a)
                n, known = part[length].to_numpy(zero_copy_only=False).astype(np.int64), part["known"]
                ends = np.concatenate([[0], np.cumsum(n + 1)])
                of = np.repeat(np.arange(b - a), pc.fill_null(pc.list_value_length(known), 0).to_numpy(zero_copy_only=False))
                flat = dict(zip([f.name for f in known.type.value_type], known.flatten().flatten(), strict=True))
                pos = flat["pos"].to_numpy(zero_copy_only=False).astype(np.int64)
                inside = (pos >= 1) & (pos <= n[of])
                at, arrays = (ends[of] + pos)[inside], []
                for c in sums:
                    values = np.zeros(ends[-1])
                    values[at] = pc.fill_null(flat[c], 0).to_numpy(zero_copy_only=False)[inside]
                    arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values)))
                yield pa.RecordBatch.from_arrays([*[part[f.name] for f in kept], *arrays], names=[f.name for f in kind])

    return rows.select(*[f.name for f in kept], "known").mapInArrow(fill, kind)


def merge_positions(parts: list[DataFrame], strict: bool = False) -> DataFrame:
    """Tables of parts added up. strict leaves the deletions of all but the first out, as a merge that forgets them."""
    if strict:
        parts = [parts[0], *(p.withColumn("del", F.lit(0).cast("long")) for p in parts[1:])]
    return reduce(DataFrame.unionByName, parts).groupBy("rname", "pos").agg(*[F.sum(c).cast("long").alias(c) for c in SUMS])


def merge_parts(counted: DataFrame, part: str, strict_first: int | None = None) -> DataFrame:
    """merge_positions() of one table of all parts, told apart by a column. strict_first: the part whose deletions alone
    count, as by a merge that forgets the others'."""
    known = counted if strict_first is None else counted.withColumn("del", F.when(F.col(part) == strict_first, F.col("del")).otherwise(0))
    return known.groupBy("rname", "pos").agg(*[F.sum(c).cast("long").alias(c) for c in SUMS])


def merge_mutation_counts(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy("rname", "n_mut").agg(F.sum("reads").cast("long").alias("reads"))


def merge_read_counts(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy("rname").agg(*[F.sum(c).cast("long").alias(c) for c in ("num_reads", "num_aligned", *REASONS)])


def merge_conflicts(parts: list[DataFrame], by: tuple[str, ...] = ("sequence", "structure", "data_type", "start", "end")) -> DataFrame:
    """References whose descriptions differ between parts, and may therefore not be merged: (rname, field, kinds)."""
    all_ = reduce(lambda a, b: a.unionByName(b), parts)
    counted = all_.groupBy("rname").agg(*[F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("\0"))).alias(c) for c in by])
    long = counted.select("rname", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("kinds")) for c in by])).alias("x"))
    return long.select("rname", "x.*").filter("kinds > 1")


def population_average(dense: DataFrame, structures: DataFrame | None = None) -> DataFrame:
    """(rname, position, mismatches, mismatch_del, nuc[, structure]); NaN where nothing is known."""
    out = dense.select(
        "rname", F.col("pos").alias("position"), half_even(ratio(F.col("mut"), F.col("info")), 5).alias("mismatches"),
        half_even(ratio(F.col("mut") + F.col("del"), F.col("info")), 5).alias("mismatch_del"), "nuc",
    )
    if structures is None:
        return out
    each = structures.select(F.col("name").alias("rname"), F.posexplode(F.split("structure", "")).alias("at", "structure")).filter("structure <> ''").select("rname", (F.col("at") + 1).alias("position"), "structure")
    return out.join(each.hint("merge"), ["rname", "position"], "left")  # as long as all references: never broadcast


def read_coverage(dense: DataFrame, counts: DataFrame) -> DataFrame:
    """(rname, position, coverage): the share of all reads, also rejected ones, that are known at each position."""
    return dense.join(counts.select("rname", "num_reads"), "rname").select("rname", F.col("pos").alias("position"), ratio(F.col("cov"), F.col("num_reads")).alias("coverage"))


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(half_even(part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * 100, 2))


#: The numbers of mutations, from and to, of each column of shares; exactly 4 have none.
SHARES = {"no_mut": (0, 0), "1_mut": (1, 1), "2_mut": (2, 2), "3_mut": (3, 3), "3plus_mut": (5, 1 << 30)}


def _share_sums(reads: Column) -> list[Column]:
    return [F.coalesce(F.sum(F.when(F.col("n_mut").between(low, high), reads)), F.lit(0)).alias(n) for n, (low, high) in SHARES.items()]


def _shares(whole: Column) -> list[Column]:
    return [_percent(F.coalesce(n, F.lit(0)), whole).alias(n) for n in SHARES]


def percent_mutations(nmut: DataFrame, counts: DataFrame) -> DataFrame:
    """Shares of fragments with 0, 1, 2, 3 and at least 5 mutations (exactly 4 have no column)."""
    sums = nmut.groupBy("rname").agg(*_share_sums(F.col("reads")))
    return counts.select("rname", "num_aligned").join(sums, "rname", "left").select("rname", *_shares(F.col("num_aligned")))


def fragment_shares(judged: DataFrame, refs: DataFrame) -> DataFrame:
    """percent_mutations() of every reference, straight from the fragments: a task has one row of sums for each reference
    that it meets, which moves once, or not at all where the fragments came by reference."""
    sums = judged.filter(F.col("reason").isNull()).groupBy("rname").agg(F.count("*").alias("num_aligned"), *_share_sums(F.lit(1)))
    return refs.select("rname").join(sums, "rname", "left").select("rname", *_shares(F.coalesce("num_aligned", F.lit(0))))


def signal_to_noise(dense: DataFrame) -> DataFrame:
    """(rname, sn): mutations for each A or C to mutations for each other base; 0 without mutations at others, null
    where a reference lacks one of the kinds."""
    ac = F.col("nuc").isin("A", "C")
    sums = dense.groupBy("rname").agg(F.sum(F.when(ac, F.col("mut")).otherwise(0)).alias("s"), F.sum(F.when(~ac, F.col("mut")).otherwise(0)).alias("n"), _count(ac).alias("ns"), _count(F.col("nuc").isin("G", "U", "T")).alias("nn"))
    signal, noise = (F.col(a).cast("double") / F.nullif(F.col(b), F.lit(0)) for a, b in (("s", "ns"), ("n", "nn")))
    return sums.select("rname", F.when(signal.isNotNull() & (noise == 0), F.lit(0.0)).otherwise(half_even(signal / F.nullif(noise, F.lit(0.0)), 2)).alias("sn"))


def summary(refs: DataFrame, pos: DataFrame, nmut: DataFrame, counts: DataFrame) -> DataFrame:
    """name, reads, aligned, no_mut, 1_mut, 2_mut, 3_mut, 3plus_mut, sn of every reference."""
    every = with_all_references(counts, refs)
    out = every.join(percent_mutations(nmut, every), "rname").join(signal_to_noise(dense_positions(pos, refs, ("mut",))), "rname")
    return out.select(F.col("rname").alias("name"), F.col("num_reads").alias("reads"), _percent(F.col("num_aligned"), F.col("num_reads")).alias("aligned"), "no_mut", "1_mut", "2_mut", "3_mut", "3plus_mut", "sn")


#: Columns that report() knows; the second name of a pair is another one for the same.
REPORT_COLUMNS = (
    "name", "sequence", "structure", "num_reads", "reads", "num_aligned", "aligned", "num_of_mutations", "no_mut", "1_mut", "2_mut", "3_mut", "3plus_mut", "percent_mutations",
    "signal_to_noise", "sn", "read_coverage", "pop_avg", "pop_avg_del", "skips", "mod_bases", "mut_bases", "del_bases", "cov_bases", "info_bases",
)


def report(refs: DataFrame, tallied: DataFrame, columns: tuple[str, ...], structures: DataFrame | None = None) -> DataFrame:
    """The columns asked for, of every reference, from staged tallies(). Series are arrays by position; num_of_mutations
    counts fragments by number of mutations, from 0 to the reference's length; skips and mod_bases are maps.

    Only what the columns need is joined, and moved; num_of_mutations alone reads tallied once, so it needs no staging.
    """
    if unknown := [c for c in columns if c not in REPORT_COLUMNS]:
        raise InputError(f"unknown report columns: {', '.join(unknown)}")
    want = set(columns)
    counts, nmut = with_all_references(of_reads(tallied), refs), of_mutations(tallied)
    out = refs.select("rname", *want & {"sequence"}, F.length("sequence").alias("ref_length"))
    shares = ["no_mut", "1_mut", "2_mut", "3_mut", "3plus_mut"]
    if want & {"num_reads", "reads", "num_aligned", "aligned", "skips", "read_coverage"}:
        out = out.join(counts, "rname")
    if want & {*shares, "percent_mutations"}:
        out = out.join(percent_mutations(nmut, counts), "rname")
    if want & {"signal_to_noise", "sn"}:
        out = out.join(signal_to_noise(dense_positions(of_positions(tallied), refs, ("mut",))), "rname")
    if "num_of_mutations" in want:
        by_n = nmut.groupBy("rname").agg(F.map_from_entries(F.collect_list(F.struct("n_mut", "reads"))).alias("by_n"))  # at most a reference's length
        filled = F.transform(F.sequence(F.lit(0), F.col("ref_length")), lambda i: F.coalesce(F.try_element_at("by_n", i), F.lit(0).cast("long")))
        out = out.join(by_n, "rname", "left").withColumn("num_of_mutations", filled).drop("by_n")
    if want & {"read_coverage", "pop_avg", "pop_avg_del", "mod_bases", "mut_bases", "del_bases", "cov_bases", "info_bases"}:
        out = out.join(dense_series(of_positions(tallied), refs), "rname", "left")
    if "structure" in want:
        known = structures.select(F.col("name").alias("rname"), "structure") if structures is not None else refs.select("rname", F.lit(None).cast("string").alias("structure"))
        out = out.join(known, "rname", "left")

    def along(f) -> Column:
        return F.transform(F.col("series"), f)

    def counts_of(c: str) -> Column:
        return along(lambda s: s[c])

    values = {
        "name": F.col("rname"), "reads": F.col("num_reads"), "aligned": _percent(F.col("num_aligned"), F.col("num_reads")), "signal_to_noise": F.col("sn"), "percent_mutations": F.array(*shares),
        "read_coverage": along(lambda s: ratio(s["cov"], F.col("num_reads"))), "pop_avg": along(lambda s: half_even(ratio(s["mut"], s["info"]), 5)), "pop_avg_del": along(lambda s: half_even(ratio(s["mut"] + s["del"], s["info"]), 5)),
        "skips": F.create_map(*[x for r in REASONS for x in (F.lit(r), F.col(r))]), "mod_bases": F.create_map(*[x for b in BASES for x in (F.lit(b), counts_of(b))]), **{f"{c}_bases": counts_of(c) for c in ("mut", "del", "cov", "info")},
    }
    return out.select(*[values.get(c, F.col(c)).alias(c) for c in columns])


def skip_summary(counts: DataFrame) -> DataFrame:
    """The share of reads rejected for each reason."""
    return counts.select("rname", "num_reads", *[_percent(F.col(r), F.col("num_reads")).alias(r) for r in REASONS])
