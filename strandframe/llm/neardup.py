"""MinHash near-duplicates by a signature-coordinate inverted join.

1. Every row has a place of its own (its file and number there), and its text becomes the set of its word shingles;
   rows of equal sets are one class, known by a 128-bit sum over the set. What follows works on one row of each class
   (smallest id, then key).
2. A class's signature has ``COORDINATES`` coordinates, each the hash of several MinHash values, so linked sets agree in
   a coordinate with the probability similarity ** rows, sets with only a passage in common hardly ever. ``threshold``
   is the largest number of agreements that a pair of just the similarity wanted reaches with all but a probability of
   ``LOSS``; the number of rows is the largest that leaves a threshold of ``LEAST`` agreements.
3. Classes are posted under each coordinate and value. Values that only one class has can't collide and are skipped, and
   so is a class with fewer than threshold shared values. Of its m shared values it posts only the m - threshold + 1
   rarest (prefix filter in one global order: two classes that agree in threshold values meet in both prefixes), so
   the long lists are met by nobody who could do without them.
4. Each list has a hub, its member with the most company (the sum of the lengths of its lists). Members are paired with
   the hub only (a star, as long as the list); pairs agreeing in threshold coordinates are confirmed on the full sets,
   and links make components. Between texts that are connected nothing is left to find. What is left, pairs of
   different components that meet in a list, is found without pairing all members:

   * if both were compared with the hub, by what tells each of them from the hub (shingles missing and added). How many
     of these differences two sets must have in common to be linked follows from their numbers, so a second inverted
     join over the differences, with the same prefix rule and a rule on the places in both prefixes, leaves hardly any
     pair that isn't linked: copies that were edited each in its own way share no differences;
   * else (one of them doesn't agree with the hub) by pairs within the list, if it has up to ``CROWD`` such members. In
     longer ones (texts that share a passage) members meet by a second value that they have in common, chosen by the same
     prefix rule among the values that the list's members share: two that agree in threshold coordinates agree in
     threshold - 1 besides the list's own. This loses nothing, and members with only the passage meet few others.

   So copies don't become all pairs, yet no link that could join components is lost (but for LOSS).
5. Components by min-label propagation with pointer jumping over the links, staged at each round. A component is named
   after its smallest id; of the rows with this id, the one with the smallest key is kept.

Scale: texts are read twice (sets and signatures; the full sets of candidates only) and never copied; shuffles carry
signatures, postings and the candidates' sets, and texts only where the candidates' keys are too many to be broadcast.
Lists are counted with partial aggregation and joined by key, so that a hot list is split by AQE's skew join; a hub's
pairs are dealt in pieces of ``PIECE``, to each of which its set goes once; no list is collected into one row or task.
Every step is staged in the shared folder. Nothing is collected to the driver but counts.

Defined results: a text with fewer words than a shingle is the one shingle of all its words; null texts and texts
without words are linked with nothing (n_shingles 0, kept); rows that share an id are documents of their own, repeated
ones linked like copies, so that just one row of each component is kept; rows with a null id are linked with nothing,
have a null component and are kept; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import math
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandframe.llm.common import PLACE, placed, slices, small, stage
from strandframe.llm.words import mix, shingles, word_hashes

COORDINATES, MOST_ROWS, LEAST = 48, 6, 4
LOSS = 1e-7
#: Pairs of one hub that are compared in a task's one piece.
PIECE = 256
#: Members of a list that may be paired with all of it; longer lists are parted by a second value.
CROWD = 32

_SEEDS = mix(np.arange(1, COORDINATES * MOST_ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
_ODD = mix(_SEEDS) | np.uint64(1)


def agreement_threshold(similarity: float, rows: int, coordinates: int = COORDINATES, loss: float = LOSS) -> int:
    """The largest t so that a pair of this similarity agrees in fewer than t coordinates with a probability up to loss."""
    below, t, p = 0.0, 0, similarity**rows
    while t < coordinates:
        below += math.comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > loss:
            break
        t += 1
    return max(1, t)


def signature_rows(percent: int) -> int:
    """MinHash values of a coordinate: as many as leave a threshold of LEAST agreements."""
    return max((r for r in range(1, MOST_ROWS + 1) if agreement_threshold(percent / 100, r) >= LEAST), default=1)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The different shingles of a whole text, rising."""
    return np.unique(shingles(word_hashes((text or "").encode("utf-8", "surrogatepass")), width))


def signature(values: np.ndarray, rows: int) -> np.ndarray:
    """The coordinates of a set (not empty), as 64-bit numbers that also tell the coordinate."""
    seeds, odd = _SEEDS[: COORDINATES * rows], _ODD[: COORDINATES * rows]
    least = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 2048):
        np.minimum(least, ((values[None, at : at + 2048] ^ seeds) * odd).min(1), out=least)
    out = np.arange(COORDINATES, dtype=np.uint64)
    for column in least.reshape(COORDINATES, rows).T:
        out = mix(out ^ column)
    return out


def sets(rows: DataFrame, width: int, signature_rows: int) -> DataFrame:
    """(the columns PLACE, doc_id, n_shingles, low, high, signature): low and high, 64-bit sums that stand for the set; no shuffle."""

    def run(batches):
        for batch in slices(batches):
            n = batch.num_rows
            count, low, high = (np.zeros(n, np.int64) for _ in range(3))
            lists: list[list[int] | None] = [None] * n
            for i, text in enumerate(batch.column(3).to_pylist()):
                values = shingle_set(text, width)
                if len(values):
                    count[i] = len(values)
                    low[i] = mix(values).sum(dtype=np.uint64).view(np.int64)
                    high[i] = mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)
                    lists[i] = signature(values, signature_rows).view(np.int64).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(count), pa.array(low), pa.array(high), pa.array(lists, pa.list_(pa.int64()))], names=[*PLACE, "doc_id", "n_shingles", "low", "high", "signature"])

    return rows.select(*PLACE, rows["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, f"{PLACE[0]} long, {PLACE[1]} long, doc_id long, n_shingles long, low long, high long, signature array<long>")


def postings(classes: DataFrame, threshold: int) -> DataFrame:
    """(value, rep, n_shingles, company) of the prefix of every class that has threshold shared values."""
    each = classes.select("rep", F.col("n_shingles").cast("int").alias("n_shingles"), F.explode("signature").alias("value"))
    shared = stage(each.groupBy("value").agg(F.count("*").alias("size")).filter("size > 1"), "dup-shared")
    met = each.join(small(shared), "value")
    own = Window.partitionBy("rep")
    ranked = met.withColumn("place", F.row_number().over(own.orderBy("size", "value"))).withColumn("m", F.count("*").over(own)).withColumn("company", F.sum("size").over(own))
    return ranked.filter(F.col("place") <= F.col("m") - threshold + 1).select("value", "rep", "n_shingles", "company")


def _similar_sizes(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _in_pieces(pairs: DataFrame, sides: DataFrame, value: str) -> DataFrame:
    """pairs (a, b) with a column of both sides' rows, ``value`` of rep, as x and y. A row of sides goes once to each
    piece of its pairs, so that no task gets all pairs of an a that has many."""
    # Pieces are made of the b's, so that how many there are is known before they are dealt.
    most = pairs.groupBy("a").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("pieces"))
    many = small(stage(most.filter("pieces > 1").select(F.col("a").alias("m_a"), "pieces"), "dup-many"))
    piece = F.coalesce(F.pmod(F.xxhash64("b"), F.col("pieces")), F.lit(0)).cast("int")
    dealt = pairs.join(many, F.col("a") == F.col("m_a"), "left").withColumn("piece", piece).select("a", "b", "piece")
    left = sides.join(many, F.col("rep") == F.col("m_a"), "left").select(F.col("rep").alias("p_a"), F.col(value).alias("x"), F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)).alias("p_piece"))
    both = dealt.join(left, (F.col("a") == F.col("p_a")) & (F.col("piece") == F.col("p_piece")))
    return both.join(sides.select(F.col("rep").alias("b"), F.col(value).alias("y")), "b").select("a", "b", "x", "y")


def _agreeing(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b), staged, whose signatures agree in threshold coordinates at least."""
    same = F.size(F.filter(F.zip_with("x", "y", lambda x, y: x == y), lambda x: x))
    return _in_pieces(pairs, classes, "signature").filter(same >= threshold).select("a", "b")


def compared(pairs: DataFrame, rows: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs, staged, with their full sets compared: (a, b, linked, n_a, missing, added, differences). missing and
    added: numbers of shingles of a that b lacks, and the other way; differences: these shingles, added ones marked.
    Each row of a pair is cut into shingles once."""
    wanted = pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep"))).distinct()
    wanted = stage(classes.join(wanted, "rep", "left_semi").select("rep", *PLACE), "dup-wanted")
    mark = np.uint64(0x5851F42D4C957F2D)

    def cut(batches):
        for batch in slices(batches):
            packed = [shingle_set(t, width).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["rep", "packed"])

    def compare(batches):
        for batch in slices(batches):
            linked, sizes, missing, added, differences = [], [], [], [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                less, more = np.setdiff1d(p, q, assume_unique=True), np.setdiff1d(q, p, assume_unique=True)
                common = len(p) - len(less)
                linked.append(100 * common >= percent * (len(p) + len(more)))
                sizes.append(len(p))
                missing.append(len(less))
                added.append(len(more))
                differences.append(np.concatenate((less, mix(more ^ mark))).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, differences)]).astype(np.int32)), pa.array(np.concatenate([np.empty(0, np.int64), *differences])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_()), *(pa.array(c, pa.int64()) for c in (sizes, missing, added)), lists], names=["a", "b", "linked", "n_a", "missing", "added", "differences"])

    found = rows.select(*PLACE, "text").join(small(wanted), list(PLACE)).select("rep", "text")
    full = stage(found.mapInArrow(cut, "rep long, packed binary"), "dup-sets")
    return _in_pieces(pairs, full, "packed").mapInArrow(compare, "a long, b long, linked boolean, n_a long, missing long, added long, differences array<long>")


def by_differences(tested: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of documents tested with the same hub, of different components, that can be linked.

    tested: (hub, rep, component, linked, n_hub, missing, added, differences). With u = 100 * missing + percent * added,
    two sets are linked if and only if their common differences number u1 + u2 - (100 - percent) * n_hub, divided by
    100 + percent, or more; and one is linked with the hub if u <= (100 - percent) * n_hub. So a set of m differences
    that others have too can't be linked with one whose u is above (100 + percent) * m + (100 - percent) * n_hub less
    its own u: a difference that only such sets have is left out, and sets that have nothing but a passage in common
    with the hub, and with each other, aren't posted at all.
    """
    mixed = tested.groupBy("hub").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).filter("c1 <> c2").select("hub")
    mixed = small(stage(mixed, "dup-mixed"))  # else all of a hub's rows would be shuffled to one task
    u, slack, whole = 100 * F.col("missing") + percent * F.col("added"), (100 - percent) * F.col("n_hub"), 100 + percent
    # At least so many common differences with any partner: one that is linked needs a partner that isn't.
    least = F.greatest(F.lit(1), F.ceil(F.when(F.col("linked"), u + 1).otherwise(u - slack) / F.lit(float(whole))))
    each = tested.join(mixed, "hub", "left_semi").select("hub", "rep", "component", u.alias("u"), slack.alias("slack"), least.alias("least"), F.explode("differences").alias("d"))
    shared = each.groupBy("hub", "d").agg(F.count("*").alias("size"), F.min("u").alias("near"), F.min("component").alias("c1"), F.max("component").alias("c2")).filter("c1 <> c2").drop("c1", "c2")
    own = Window.partitionBy("hub", "rep")
    able = each.join(shared, ["hub", "d"]).withColumn("m", F.count("*").over(own)).filter(F.col("near") <= whole * F.col("m") + F.col("slack") - F.col("u"))
    nearest = F.ceil((F.col("u") + F.min("near").over(own) - F.col("slack")) / F.lit(float(whole)))
    ranked = able.withColumn("least", F.greatest("least", nearest)).withColumn("place", F.row_number().over(own.orderBy("size", "d"))).withColumn("m", F.count("*").over(own))
    posted = stage(ranked.filter(F.col("place") <= F.col("m") - F.col("least") + 1).drop("near"), "dup-differences")
    x, y = posted.alias("x"), posted.alias("y")
    need = F.ceil((F.col("x.u") + F.col("y.u") - F.col("x.slack")) / F.lit(float(whole)))
    meet = (F.col("x.hub") == F.col("y.hub")) & (F.col("x.d") == F.col("y.d")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.component") != F.col("y.component"))
    reach = (F.col("x.place") <= F.col("x.m") - need + 1) & (F.col("y.place") <= F.col("y.m") - need + 1)
    return x.join(y, meet & reach).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()


def _of_lists(members: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Pairs (a, b) of members (the keys, rep, n_shingles, known, component) of one list, of different components and
    similar sizes, of which one isn't known."""
    x, y = members.filter("not known").alias("x"), members.alias("y")
    meet = (F.col("x.rep") != F.col("y.rep")) & (F.col("x.component") != F.col("y.component")) & _similar_sizes(F.col("x.n_shingles"), F.col("y.n_shingles"), percent)
    for k in keys:
        meet &= F.col(f"x.{k}") == F.col(f"y.{k}")
    return x.join(y, meet).select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))


def apart(members: DataFrame, classes: DataFrame, threshold: int, percent: int) -> DataFrame:
    """Pairs (a, b) of members of a list, of which one doesn't agree with the list's hub, that can agree in threshold
    coordinates; of different components and similar sizes.

    members: (value, rep, n_shingles, known, component), staged; known: agrees with the hub, or is it.
    """
    strange = F.count_if(~F.col("known"))
    lists = stage(members.groupBy("value").agg(strange.alias("strange"), F.min("component").alias("c1"), F.max("component").alias("c2")).filter("strange > 0 and c1 <> c2").select("value", "strange"), "dup-lists")
    few = lists.filter(F.col("strange") <= CROWD) if threshold > 1 else lists
    pairs = _of_lists(members.join(small(few.select("value")), "value", "left_semi"), ["value"], percent)
    if threshold > 1:
        crowd = members.join(small(lists.filter(F.col("strange") > CROWD).select("value")), "value", "left_semi")
        signatures = classes.select("rep", "signature")
        each = crowd.join(signatures, "rep").select("value", "rep", "n_shingles", "known", "component", F.explode("signature").alias("second")).filter("second <> value")
        each = stage(each, "dup-crowd")
        sizes = each.groupBy("value", "second").agg(F.count("*").alias("size"), strange.alias("strange"), F.min("component").alias("c1"), F.max("component").alias("c2")).filter("strange > 0 and c1 <> c2").select("value", "second", "size")
        own = Window.partitionBy("value", "rep")
        ranked = each.join(sizes, ["value", "second"]).withColumn("place", F.row_number().over(own.orderBy("size", "second"))).withColumn("m", F.count("*").over(own))
        parted = stage(ranked.filter(F.col("place") <= F.col("m") - threshold + 2).drop("place", "m", "size"), "dup-parted")
        pairs = pairs.union(_of_lists(parted, ["value", "second"], percent))
    return pairs.distinct()


def components(links: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """(rep, component): the smallest rep that each end of a link is connected with.

    start: labels (rep, component) known already. Each round takes the smallest label of all neighbours and then the
    label's own label, so the distance to the smallest is at least halved on paths of rising labels.
    """
    ends = links.select(F.col("a").alias("x"), F.col("b").alias("y"))
    if start is not None:
        ends = ends.union(start.select(F.col("rep"), F.col("component")).filter("rep <> component"))
    both = stage(ends.union(ends.select("y", "x")).distinct(), "dup-links")
    labels = stage(both.groupBy(F.col("x").alias("rep")).agg(F.least(F.col("rep"), F.min("y")).alias("component")), "dup-labels")
    while True:
        near = both.join(labels, both["y"] == labels["rep"]).groupBy(F.col("x").alias("rep")).agg(F.min("component").alias("near"))
        own = labels.join(near, "rep").select("rep", F.col("component").alias("had"), F.least("component", "near").alias("next"))
        jump = labels.select(F.col("rep").alias("next"), F.col("component").alias("far"))
        after = stage(own.join(jump, "next", "left").select("rep", "had", F.least("next", F.coalesce("far", "next")).alias("component")), "dup-labels")
        changed = after.filter("had <> component").limit(1).count()
        labels = after.select("rep", "component")
        if not changed:
            return labels


def decided(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """(the columns PLACE, doc_id, n_shingles, component_id, kept) of every row of a placed() table."""
    per = signature_rows(percent)
    threshold = agreement_threshold(percent / 100, per)
    own = stage(sets(rows, width, per).withColumn("row_key", F.monotonically_increasing_id()), "dup-own")
    real = own.filter("n_shingles > 0 and doc_id is not null")
    grouped = real.groupBy("low", "high", "n_shingles").agg(F.min(F.struct("doc_id", "row_key", *PLACE)).alias("top"), F.first("signature").alias("signature"))
    first = F.struct(F.col("top.doc_id").alias("doc_id"), F.col("top.row_key").alias("row_key")).alias("first")
    classes = stage(grouped.select("low", "high", "n_shingles", F.col("top.row_key").alias("rep"), first, *[F.col(f"top.{c}").alias(c) for c in PLACE], "signature"), "dup-classes")
    posted = stage(postings(classes, threshold), "dup-postings")

    hubs = posted.groupBy("value").agg(F.max(F.struct("company", (-F.col("rep")).alias("rep"))).alias("top"), F.count("*").alias("size")).filter("size > 1")
    met = stage(posted.join(hubs, "value").select("value", "rep", "n_shingles", (-F.col("top.rep")).alias("hub")), "dup-met")
    star = stage(met.filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), "dup-pairs")
    tried = stage(_agreeing(star, classes, threshold), "dup-star")
    tested = stage(compared(tried, rows, classes, width, percent), "dup-tested")
    labels = components(tested.filter("linked").select("a", "b"))

    label = labels.select(F.col("rep").alias("l_rep"), "component")

    def labelled(df: DataFrame) -> DataFrame:
        return df.join(label, F.col("rep") == F.col("l_rep"), "left").withColumn("component", F.coalesce("component", "rep")).drop("l_rep")

    close = by_differences(labelled(tested.withColumnsRenamed({"a": "hub", "b": "rep", "n_a": "n_hub"})), percent)
    known = tried.select(F.col("a").alias("hub"), F.col("b").alias("rep"), F.lit(True).alias("known"))
    open_ = stage(labelled(met.join(known, ["hub", "rep"], "left").withColumn("known", F.coalesce("known", F.col("rep") == F.col("hub")))), "dup-open")
    rest = stage(close.union(_agreeing(stage(apart(open_, classes, threshold, percent), "dup-apart"), classes, threshold)).distinct(), "dup-rest")
    if rest.take(1):
        more = stage(compared(rest, rows, classes, width, percent).filter("linked").select("a", "b"), "dup-linked")
        labels = components(more, labels)

    # A component's first row, by id and key: components are labelled by keys so far.
    first = classes.join(labels, "rep").groupBy("component").agg(F.min("first").alias("top"))
    tops = labels.join(first, "component").select("rep", "top")
    of_class = classes.join(tops, "rep", "left").select("low", "high", "n_shingles", F.coalesce("top", "first").alias("top"))
    linked = own.join(of_class, ["low", "high", "n_shingles"], "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    component, kept = F.when(alone, F.col("doc_id")).otherwise(F.col("top.doc_id")), alone | (F.col("row_key") == F.col("top.row_key"))
    return linked.select(*PLACE, "doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents are linked if 100 * |A & B| >= percent * |A | B| for their
    sets of shingles of width words."""
    return decided(placed(docs.select("doc_id", "text"), "dup-rows"), width, percent).drop(*PLACE)


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows that are kept: one of each group, the one with the smallest id (of several, just one)."""
    rows = placed(docs, "dup-rows")
    gone = stage(decided(rows, width, percent).filter(~F.col("kept")).select(*PLACE), "dup-gone")
    return rows.join(small(gone), list(PLACE), "left_anti").select(*docs.columns)
