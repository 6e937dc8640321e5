"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree. DataFrame functions only.

1. Sizes: the words of every document; the total of every source.
2. Targets: sources by code point (null last) weigh ``weights``, repeating; they share ``share`` times all words; no
   target is above ``most`` times its source's words, and what is cut goes to the others by weight, again and again
   until no target is above (each round is one sum over the sources).
3. Layout: a source's documents stand one behind the other in an order permuted by a hash of id and text; ``most``
   passes over this order make the source's stream. The source gives the first words of its stream, exactly its target
   (rounded): so all its documents are used equally often, but for one document at most the words taken are whole
   copies, and none is used more than ``most`` times.
4. Splitting tree: a source's words drawn are so many blocks. From the root, each node splits its blocks in two
   halves; how many blocks of each source go left is drawn from the multivariate hypergeometric distribution (source
   by source, by inverting the distribution function at a hashed uniform number). Leaves are the output shards: with
   exact block quotas of each source, in the proportions of the mix. Sources stand in groups of ``GROUP``: one tree
   splits the groups' totals, then each group's tree splits what its group got at each node.
5. A shard takes its quota of a source as the next blocks of the permuted stream, disjoint from other shards'; what it
   takes of each document is in the result. Within a shard, documents are shuffled by a hash.

Scale: texts are read once, to count words; all else is on rows of a few numbers. Sources are rows, numbered by sorted
ranges; no row or task holds them all (an array has one entry for each source of a group, or for each group). The order
of a source is a prefix sum in two levels over hash ranges of about ``RANGE_DOCS`` documents, so no task holds a source.
The mix itself shuffles texts twice, at any size: to join a row with its copies, and to the partitions of its shards, of
which there are as many as the words drawn ask for.

Defined results: null and empty texts have size 0 and take 0; a null source is a source of its own, last; repeated
rows count as documents of their own (those equal in id and text stand side by side); with no words at all, all targets
are 0; an empty table gives an empty result; other columns play no part. Reruns agree, since every draw is a hash.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandframe.llm.common import PLACE, placed, stage
from strandframe.operators.chunks import numbered

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a hash range of a source, about.
RANGE_DOCS = 4096
#: Sources of a group; words of an output partition, about.
GROUP, PART_WORDS = 1000, 8_000_000


def _unit(*cols: Column) -> Column:
    """A number in [0, 1) from a hash of the columns: the first 32 bits of md5, so that any SQL engine can follow."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[c.cast("string") for c in cols])), 1, 8), 16, 10).cast("double") / 2.0**32


def _ln_factorials(*n: Column) -> Column:
    """The sum of ln n! of all n, by Stirling's series at n + 8."""

    def one(n: Column) -> Column:
        x = n.cast("double") + 8.0
        below = reduce(lambda a, b: a * b, [x - float(k) for k in range(8)])
        return (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12.0 * x) - 1 / (360.0 * x * x * x) - F.log(below)

    return F.aggregate(F.array(*n), F.lit(0.0), lambda total, x: total + one(x))


def _hypergeometric(u: Column, total: Column, good: Column, drawn: Column) -> Column:
    """The number of good blocks among ``drawn`` of ``total``, at the point u of the distribution function.

    The sum runs over 12 standard deviations on both sides of the mean; what lies outside is below 1e-30.
    """
    t = F.greatest(total, F.lit(1)).cast("double")
    mean = drawn * good / t
    reach = 12.0 * F.sqrt(F.greatest(F.lit(0.0), mean * (1 - good / t) * (total - drawn) / F.greatest(t - 1, F.lit(1.0)))) + 8
    least, most = F.greatest(F.lit(0).cast("long"), drawn - (total - good)), F.least(good, drawn)
    bounds = F.struct(F.greatest(least, F.floor(mean - reach).cast("long")).alias("lo"), F.least(most, F.ceil(mean + reach).cast("long")).alias("hi"))

    def value(b: Column) -> Column:
        lo, hi = b["lo"], b["hi"]
        chance = F.exp(_ln_factorials(good, total - good, drawn, total - drawn) - _ln_factorials(lo, good - lo, drawn - lo, total - good - drawn + lo, total))
        start = F.struct(u.alias("u"), chance.alias("sum"), chance.alias("chance"), lo.alias("k"))

        def step(acc: Column, k: Column) -> Column:  # from the chance of k - 1 to that of k
            p = acc["chance"] * ((good - k + 1) * (drawn - k + 1)).cast("double") / (k * (total - good - drawn + k)).cast("double")
            return F.when(acc["sum"] > acc["u"], acc).otherwise(F.struct(acc["u"].alias("u"), (acc["sum"] + p).alias("sum"), p.alias("chance"), k.alias("k")))

        above = F.filter(F.sequence(lo, hi), lambda k: k > lo)
        return F.aggregate(above, start, step, lambda acc: acc["k"])

    return F.transform(F.array(bounds), value)[0]


def _split(blocks: Column, left: Column, node: Column, group: Column, seed: int) -> Column:
    """How many blocks of each source (blocks: array of counts) go to the left child, which gets ``left`` in all."""
    start = F.struct(F.aggregate(blocks, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), left.alias("left"), F.array().cast("array<bigint>").alias("out"))

    def step(acc: Column, n: Column) -> Column:
        x = _hypergeometric(_unit(F.lit(seed), node, group, F.size(acc["out"])), acc["total"], n, acc["left"])
        return F.transform(F.array(x), lambda v: F.struct((acc["total"] - n).alias("total"), (acc["left"] - v).alias("left"), F.concat(acc["out"], F.array(v)).alias("out")))[0]

    return F.aggregate(blocks, start, step, lambda acc: acc["out"])


def _tree(root: Column, lefts: Column | None, group: Column, shards: int, seed: int) -> Column:
    """array<array>: the blocks of every node, 1 to 2 * shards - 1, of a tree whose root has these; node n's children
    are 2n and 2n + 1. lefts: how many blocks go left at each inner node (half of them, if not given)."""

    def step(quotas: Column, node: Column) -> Column:
        own = F.get(quotas, node - 1)
        half = F.floor((F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a + x) + 1) / 2).cast("long") if lefts is None else F.get(lefts, node - 1)
        left = _split(own, half, node, group, seed)
        return F.transform(F.array(left), lambda x: F.concat(quotas, F.array(x, F.zip_with(own, x, lambda q, y: q - y))))[0]

    inner = F.sequence(F.lit(1), F.lit(shards - 1)) if shards > 1 else F.array().cast("array<int>")
    return F.aggregate(inner, F.array(root), step)


def sizes(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, key): key orders a source's documents."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    key = F.md5(F.concat(F.lit("order:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), key.alias("key"), *extra)


def targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, source_size, docs, row, target) of each source; row: its number by code point, from 0."""
    total = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")).withColumn("none", F.col("source").isNull())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("row", F.lit(len(weights))) + 1).cast("int"))
    known = stage(numbered(total, "none", "source").withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most)).drop("none"), "mix-totals")
    all_ = known.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    level, closed = (all_["words"] * share / all_["weight"], 0) if all_["weight"] else (0.0, 0)
    while True:  # the level, words a unit of weight, rises until it brings no further source over its cap
        over = F.col("weight") * F.lit(level) > F.col("cap")
        seen = known.agg(F.count_if(over).alias("n"), F.sum(F.when(over, F.col("cap"))).alias("cap"), F.sum(F.when(~over, F.col("weight"))).alias("open")).first()
        if seen["n"] == closed or not seen["open"]:
            break
        level, closed = (all_["words"] * share - seen["cap"]) / seen["open"], seen["n"]
    return known.select("source", "source_size", "docs", "row", F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target"))


def shard_cuts(target: DataFrame, shards: int = 16, blocks: int = 4096, seed: int = 1) -> DataFrame:
    """(source, source_size, docs, target, draw, cuts): draw is the target in whole words; shard i takes the words
    cuts[i] to cuts[i + 1] of the source's stream. shards: a power of two. blocks: in the whole mix, about."""
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    drawn = target.withColumn("draw", F.round("target").cast("long")).withColumn("group", F.floor(F.col("row") / GROUP).cast("long"))
    whole = drawn.agg(F.sum("draw")).first()[0] or 0
    block = F.lit(max(1, math.ceil(whole / float(blocks)))).cast("long")
    drawn = drawn.withColumn("n", F.ceil(F.col("draw") / block).cast("long"))
    groups = drawn.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("row", "n"))).alias("members"), F.sum("n").alias("n"))  # at most GROUP
    groups = stage(groups, "mix-groups")
    top = groups.groupBy().agg(F.sort_array(F.collect_list(F.struct("group", "n"))).alias("all"))
    nodes = _tree(F.transform("all", lambda g: g["n"]), None, F.lit("groups"), shards, seed)
    # Of each group, the blocks that go left at each inner node: those of the node's left child.
    inner = F.sequence(F.lit(1), F.lit(shards - 1)) if shards > 1 else F.array().cast("array<int>")
    top = top.select("all", F.explode(F.array(nodes)).alias("nodes"))
    given = top.select("nodes", F.posexplode(F.transform("all", lambda g: g["group"])).alias("at", "g_group"))
    given = stage(given.select("g_group", F.transform(inner, lambda n: F.get(F.get("nodes", 2 * n - 1), F.col("at"))).alias("lefts")), "mix-lefts")
    split = groups.join(given, F.col("group") == F.col("g_group")).select("members", F.explode(F.array(_tree(F.transform("members", lambda m: m["n"]), F.col("lefts"), F.col("group"), shards, seed))).alias("nodes"))
    leaves = split.select(F.slice("nodes", shards, shards).alias("leaves"), F.posexplode(F.transform("members", lambda m: m["row"])).alias("at", "q_row"))
    quotas = leaves.select("q_row", F.transform("leaves", lambda leaf: F.get(leaf, F.col("at"))).alias("quotas"))
    upto = F.transform(F.sequence(F.lit(0), F.lit(shards)), lambda i: F.least(F.col("draw"), block * F.aggregate(F.slice("quotas", 1, i), F.lit(0).cast("long"), lambda a, x: a + x)))
    return drawn.join(quotas, F.col("row") == F.col("q_row")).select("source", "source_size", "docs", "target", "draw", upto.alias("cuts"))


def draws(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, shards: int = 16, blocks: int = 4096, seed: int = 1) -> DataFrame:
    """The rows of sized with source_size, target, at (words of the source before this document in its order),
    shard_words (array: words that each shard takes of this document, repeats counted) and shard_copies (array:
    copies that begin in each shard's words, more than half of whose words are drawn).

    sized: rows of sizes(), staged, since they are used several times.
    """
    source = stage(shard_cuts(targets(sized, weights, share, most), shards, blocks, seed), "mix-sources")
    s = source.select(F.col("source").alias("s_source"), "source_size", "docs", "target", "draw", "cuts")
    place = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / 2.0**32 * F.greatest(F.lit(1.0), F.ceil(F.col("docs") / RANGE_DOCS))).cast("long")
    placed = sized.join(s, F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source").withColumn("place", place)
    order = ["key", "size", *(c for c in PLACE if c in sized.columns)]  # equal rows: in a fixed order too
    in_range = Window.partitionBy("source", "place").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    in_source = Window.partitionBy("r_source").orderBy("r_place").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy(F.col("source").alias("r_source"), F.col("place").alias("r_place")).agg(F.sum("size").alias("words"))
    ranges = ranges.select("r_source", "r_place", F.coalesce(F.sum("words").over(in_source), F.lit(0)).alias("base"))
    inner = placed.withColumn("inner", F.coalesce(F.sum("size").over(in_range), F.lit(0)))
    at = inner.join(ranges, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("place") == F.col("r_place"))).withColumn("at", F.col("base") + F.col("inner"))

    def words(i: Column) -> Column:
        lo, hi = F.get("cuts", i), F.get("cuts", i + 1)
        starts = [F.col("at") + F.col("source_size") * k for k in range(most)]
        return reduce(lambda a, b: a + b, [F.greatest(F.lit(0).cast("long"), F.least(hi, x + F.col("size")) - F.greatest(lo, x)) for x in starts])

    def copies(i: Column) -> Column:
        lo, hi = F.get("cuts", i), F.get("cuts", i + 1)
        starts = [F.col("at") + F.col("source_size") * k for k in range(most)]
        return reduce(lambda a, b: a + b, [((x >= lo) & (x < hi) & (2 * (F.col("draw") - x) >= F.col("size")) & (F.col("size") > 0)).cast("int") for x in starts])

    each = F.sequence(F.lit(0), F.lit(shards - 1))
    return at.select(*sized.columns, "source_size", "target", "at", F.transform(each, words).alias("shard_words"), F.transform(each, copies).alias("shard_copies"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shard_words) of every document: taken, the words drawn from it by all
    shards; shard_words, those drawn by each, joined by commas."""
    drawn = draws(stage(sizes(docs), "mix-sizes"), **how)
    words = F.array_join(F.transform("shard_words", lambda n: n.cast("string")), ",")
    return drawn.select("doc_id", "size", "source_size", "target", F.aggregate("shard_words", F.lit(0).cast("long"), lambda a, x: a + x).alias("taken"), words.alias("shard_words"))


def mixed_documents(docs: DataFrame, seed: int = 1, shards: int = 16, part_words: int = PART_WORDS, **how) -> DataFrame:
    """The mix itself: the columns of docs, one row for each copy drawn, and shard (with underscores behind it, if docs
    has that column); shuffled within each shard.

    A row drawn in part counts as whole if at least half of it is drawn. Rows are told apart by their places, by which
    their copies are joined to them, so each row gets just its own copies, whatever ids are null or shared.
    """
    rows = placed(docs, "mix-rows")
    sized = stage(sizes(rows, PLACE), "mix-sizes")
    drawn = draws(sized, seed=seed, shards=shards, **how)
    copies = F.flatten(F.transform("shard_copies", lambda n, i: F.array_repeat(i, n)))
    picked = stage(drawn.select(*PLACE, "size", copies.alias("shards")).filter(F.size("shards") > 0), "mix-picked")
    words = picked.agg(F.sum(F.col("size") * F.size("shards"))).first()[0] or 0
    parts = max(1, math.ceil(words / (shards * part_words)))
    packed = rows.select(*PLACE, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    each = packed.join(picked.drop("size").hint("shuffle_hash"), list(PLACE)).select("doc", F.explode("shards").alias("shard"))
    each = each.withColumn("order", F.xxhash64(F.lit(seed), "doc", "shard"))  # rows of one id are dealt apart
    dealt = each.repartitionById(shards * parts, (F.col("shard") * parts + F.pmod("order", F.lit(parts))).cast("int"))
    name = "shard"
    while name in docs.columns:
        name += "_"
    return dealt.sortWithinPartitions("shard", "order").select("doc.*", F.col("shard").alias(name))


def oracle_sql(weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, shards: int = 16, blocks: int = 4096, seed: int = 1) -> str:
    """DuckDB SQL for mix()'s rows, for up to GROUP sources: targets by sorting the sources in the order in which a
    rising level meets their caps, and the splitting tree by recursion, a draw at each step."""
    w = "[" + ", ".join(f"{float(x)}" for x in weights) + "]"
    choose = "(lgamma({0} + 1.0) - lgamma({1} + 1.0) - lgamma({0} - ({1}) + 1.0))"
    odds = f"exp({choose.format('good', 'k')} + {choose.format('(total - good)', '(rest - k)')} - {choose.format('total', 'rest')})"
    words = " + ".join(f"greatest(0, least(hi, pos + {k} * source_size + size) - greatest(lo, pos + {k} * source_size))" for k in range(most))
    return f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    md5('order:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS key FROM documents
), total AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place, {w}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1)::INT]::DOUBLE AS weight, source_size * {float(most)}::DOUBLE AS cap FROM total
), filled AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE * {share}::DOUBLE - coalesce(sum(cap) OVER before, 0) AS rest,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weights_left
  FROM weighed WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), settled AS (
  SELECT arg_min(rest / weights_left, cap / weight) AS level FROM filled WHERE rest / weights_left * weight <= cap
), targets AS (
  SELECT source, place, source_size, least(cap, coalesce(level * weight, cap)) AS target FROM filled, settled
), drawn AS (
  SELECT *, round(target)::BIGINT AS draw, greatest(1, ceil(sum(round(target)::BIGINT) OVER () / {float(blocks)}::DOUBLE))::BIGINT AS block FROM targets
), blocked AS (
  SELECT *, ceil(draw / block::DOUBLE)::BIGINT AS n FROM drawn
), tree AS (
  SELECT 1::BIGINT AS node, 0 AS i, list(n ORDER BY place) AS quota, []::BIGINT[] AS gone, sum(n)::BIGINT AS total, ((sum(n) + 1) // 2)::BIGINT AS rest, count(*) AS sources FROM blocked
  UNION ALL
  SELECT * FROM (
    WITH open AS (SELECT *, quota[i + 1] AS good, ('0x' || substr(md5(concat_ws(':', {seed}, node, 0, i)), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM tree WHERE node < {shards} AND i < sources),
    bounds AS (SELECT *, rest * good / greatest(total, 1)::DOUBLE AS mean, 12 * sqrt(greatest(0.0, rest * good / greatest(total, 1)::DOUBLE * (1 - good / greatest(total, 1)::DOUBLE) * (total - rest) / greatest(greatest(total, 1) - 1, 1)::DOUBLE)) + 8 AS reach FROM open),
    ranged AS (SELECT *, greatest(0, rest - (total - good), floor(mean - reach))::BIGINT AS lo, least(good, rest, ceil(mean + reach))::BIGINT AS hi FROM bounds),
    summed AS (SELECT *, list_transform(range(lo, hi + 1), lambda k: {odds}) AS p FROM ranged),
    chosen AS (SELECT *, least(hi, lo + len(list_filter(range(1, len(p) + 1), lambda j: list_sum(p[1:j]) <= u))) AS x FROM summed)
    SELECT node, i + 1, quota, list_append(gone, x), total - good, rest - x, sources FROM chosen
    UNION ALL
    SELECT node * 2 + side, 0, half, []::BIGINT[], list_sum(half)::BIGINT, ((list_sum(half) + 1) // 2)::BIGINT, sources
    FROM (SELECT node, sources, side, CASE WHEN side = 0 THEN gone ELSE list_transform(range(1, len(quota) + 1), lambda j: quota[j] - gone[j]) END AS half FROM tree, (VALUES (0), (1)) s(side) WHERE node < {shards} AND i = sources)
  )
), leaves AS (
  SELECT node - {shards} AS shard, unnest(quota) AS quota, unnest(range(1, sources + 1)) AS place FROM tree WHERE node >= {shards}
), cut AS (
  SELECT place, shard, coalesce(sum(quota) OVER (PARTITION BY place ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before, quota FROM leaves
), cuts AS (
  SELECT b.source, b.place, shard, least(draw, block * before) AS lo, least(draw, block * (before + quota)) AS hi FROM cut c JOIN blocked b USING (place)
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.place, row_number() OVER () AS row,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT any_value(doc_id) AS doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target, sum(words)::BIGINT AS taken, string_agg(words::VARCHAR, ',' ORDER BY shard) AS shard_words
FROM (SELECT row, doc_id, size, source_size, target, shard, ({words})::BIGINT AS words FROM placed JOIN cuts USING (place)) GROUP BY row
"""
