"""Line dedup: two Bloom filters, of hashes seen once and seen twice; only lines that the second one suspects are shuffled,
counted exactly, and dropped or kept.

1. Each task puts the hash of every distinct line of a row into its own pair of filters: a hash that the first filter
   knows goes into the second as well. Filters are cut into segments of ``SEGMENT`` bits, which merge by segment, up to
   ``FAN`` at a time: once = a | b, twice = a2 | b2 | (a & b). So a line of two rows is in the second filter, wherever
   they were read; others are by chance.
2. Lines in the second filter are suspects. They alone are shuffled, and counted by the line itself, with partial sums:
   so the result is exact, whatever the filters hold.
3. Keys found in at least ``min_docs`` rows lose their lines. Up to ``KEYS`` such keys go to all tasks, as two 64-bit
   hashes each. Beyond that, suspects meet their keys in a join in which hot keys are dealt apart, and only rows with
   suspects are shuffled.

Scale: the filters have about 8 to 16 bits for each line, ``FILTER_BITS`` at most (64 MB each, for some 60 million lines).
Beyond that they suspect more and more, until all lines are counted exactly by partial sums: more is shuffled, in
proportion to the text, and the result is the same.

Defined results: a null or empty text is one empty line; repeated rows are documents of their own; a line often repeated
in one row counts once; lines shorter than ``min_chars`` stay; the first occurrence, if it is kept, is that with the
smallest id (null last), then place in the files and in the text; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandframe.llm.common import PLACE, attach, give_back, placed, small_batches, stage

SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of a filter at most; bits of a segment; hash functions; segments of so many tasks that merge at once.
FILTER_BITS, SEGMENT, HASHES, FAN = 1 << 29, 1 << 23, 4, 64
#: Hashes that a task gathers before it puts them into its filters.
PENDING = 1 << 20
#: Keys to drop that are sent to all tasks: 40 bytes each.
KEYS = 400_000


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def key_of(line: Column) -> Column:
    """What makes lines equal: without white space at both ends, and A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(SPACE)), UPPER, LOWER)


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """(n, HASHES) bits of each hash, by double hashing with its two halves."""
    h = hashes.view(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + high[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def _put(filter_: np.ndarray, places: np.ndarray) -> None:
    np.bitwise_or.at(filter_, places >> 3, np.uint8(1) << (places & 7).astype(np.uint8))


def _has(filter_: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((filter_[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(1)


def _values(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


_PARTS = "part int, segment int, once binary, twice binary"


def _filters(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """A task's pair of filters, by segments that aren't empty, from rows (part, hashes of distinct lines)."""
    once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
    part, pending, n = 0, [], 0

    def empty() -> None:
        nonlocal pending, n
        if n:
            hashes, times = np.unique(np.concatenate(pending), return_counts=True)
            places = _places(hashes, bits)
            again = (times > 1) | _has(once, places)
            _put(twice, places[again].ravel())
            _put(once, places.ravel())
            pending, n = [], 0

    for batch in batches:
        if batch.num_rows:
            part = batch.column("part")[0].as_py()
        pending.append(_values(batch.column("hashes")))
        n += len(pending[-1])
        if n >= PENDING:
            empty()
    empty()
    pack = zstandard.ZstdCompressor(level=1)
    step = min(bits, SEGMENT) // 8
    for at in range(0, bits // 8, step):
        if once[at : at + step].any():
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "segment": pa.array([at // step], pa.int32()), "once": pa.array([pack.compress(once[at : at + step])], pa.binary()), "twice": pa.array([pack.compress(twice[at : at + step])], pa.binary())})
    give_back()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of equal (part, segment), which follow each other, merged."""
    pack, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
    key, once, twice = None, None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"part": pa.array([key[0]], pa.int32()), "segment": pa.array([key[1]], pa.int32()), "once": pa.array([pack.compress(once)], pa.binary()), "twice": pa.array([pack.compress(twice)], pa.binary())})

    for batch in batches:
        for i in range(batch.num_rows):
            new = (batch.column("part")[i].as_py(), batch.column("segment")[i].as_py())
            a, b = (np.frombuffer(unpack.decompress(batch.column(c)[i].as_py()), np.uint8) for c in ("once", "twice"))
            if new == key:
                twice |= b | (once & a)
                once |= a
            else:
                if key is not None:
                    yield out()
                key, once, twice = new, a.copy(), b.copy()
    if key is not None:
        yield out()


def twice_filter(hashes: DataFrame, lines: int) -> np.ndarray:
    """The filter of what several rows have, as bytes. hashes: rows (hashes), the hashes of a row's distinct lines; lines:
    how many they are at most."""
    bits = 1 << min(FILTER_BITS.bit_length() - 1, max(13, (8 * max(lines, 1)).bit_length()))
    parts = hashes.select(F.spark_partition_id().alias("part"), "hashes").mapInArrow(functools.partial(_filters, bits=bits), _PARTS)
    parts = stage(parts, "line-filters")
    most = parts.agg(F.max("part")).first()[0]
    while most:
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
        parts = stage(parts.repartition("part", "segment").sortWithinPartitions("part", "segment").mapInArrow(_merged, _PARTS), "line-filters")
        most //= FAN
    twice, step = np.zeros(bits // 8, np.uint8), min(bits, SEGMENT) // 8
    for r in parts.select("segment", "twice").toLocalIterator():
        twice[r["segment"] * step : (r["segment"] + 1) * step] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(r["twice"])), np.uint8)
    return twice


def _find(h1: np.ndarray, h2: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """For each pair of hashes its place among the pairs (k1, k2), sorted by k1; -1 if it isn't there."""
    out = np.full(len(h1), -1, np.int64)
    if len(k1):
        at, open_ = np.searchsorted(k1, h1), np.arange(len(h1))
        while len(open_):
            inside = at[open_] < len(k1)
            open_ = open_[inside]
            same = k1[at[open_]] == h1[open_]
            open_ = open_[same]
            hit = k2[at[open_]] == h2[open_]
            out[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit]
            at[open_] += 1
    return out


def _lists(offsets: np.ndarray, keep: np.ndarray, values: np.ndarray) -> pa.Array:
    """The values kept, in lists by the offsets of the whole."""
    n = np.concatenate([[0], np.cumsum(keep)])[offsets]
    return pa.ListArray.from_arrays(pa.array(n.astype(np.int32)), pa.array(values[keep].astype(np.int32), pa.int32()))


def _marks(offsets: np.ndarray, marks: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(marks))


def _offsets(lists: pa.ListArray) -> np.ndarray:
    o = lists.offsets.to_numpy()
    return o - o[0]


def dedup_lines(docs: DataFrame, min_chars: int = 1, min_docs: int = 10, keep: str = "none") -> DataFrame:
    """docs without the lines whose key, of at least ``min_chars`` characters, is found in at least ``min_docs`` (2 or more)
    rows, and n_lines (before dropping) and n_dropped, with underscores behind these names if docs has them. keep: "none",
    or "first", which leaves the first occurrence of each in place."""
    if keep not in ("none", "first") or min_docs < 2:
        raise ValueError("keep is none or first; min_docs is 2 at least")
    small_batches(docs.sparkSession)
    names = []
    for name in ("n_lines", "n_dropped"):
        while name in docs.columns:
            name += "_"
        names.append(name)
    rows = placed(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")), "lines-rows")
    lines = lines_of(F.col("doc.text"))
    keys = F.transform(lines, key_of)
    known = rows.select("doc", *PLACE, keys.alias("keys"))
    # Lines that are too short get no hash pair of their own: 0, 0 is never looked for.
    long_enough = (lambda k: F.length(k) >= min_chars) if min_chars > 0 else (lambda k: F.lit(True))
    first_hash = F.transform("keys", lambda k: F.when(long_enough(k), F.xxhash64(k)).otherwise(F.lit(0).cast("long")))
    second_hash = F.transform("keys", lambda k: F.when(long_enough(k), F.xxhash64(F.lit(7), k)).otherwise(F.lit(0).cast("long")))
    total = docs.agg(F.sum(F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    distinct = F.array_distinct(F.transform(F.filter(keys, long_enough), lambda k: F.xxhash64(k)))
    suspected_ = docs.sparkSession.sparkContext.broadcast(twice_filter(rows.select(distinct.alias("hashes")), total))

    @F.arrow_udf("array<int>")
    def suspects(h1: pa.Array, h2: pa.Array) -> pa.Array:
        """The first line of each distinct pair of hashes that the filter suspects."""
        a, b, offsets = _values(h1), _values(h2), _offsets(h1)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        filter_ = suspected_.value
        maybe = np.flatnonzero(((a != 0) | (b != 0)) & _has(filter_, _places(a, len(filter_) * 8)))
        order = maybe[np.lexsort((maybe, b[maybe], a[maybe], row[maybe]))]
        if len(order):
            new = np.ones(len(order), bool)
            new[1:] = (row[order][1:] != row[order][:-1]) | (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
            order = order[new]
        kept = np.zeros(len(a), bool)
        kept[order] = True
        return _lists(offsets, kept, np.arange(len(a)) - offsets[row])

    found = known.withColumn("lines", suspects(first_hash, second_hash))
    each = found.select(*PLACE, F.col("doc.doc_id").alias("doc_id"), "keys", F.explode("lines").alias("line")).select(*PLACE, "doc_id", "line", F.get("keys", F.col("line")).alias("key"))
    each = stage(each, "line-suspects")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *PLACE, "line")
    counted = each.groupBy("key").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter(F.col("n") >= min_docs)
    exempt = [F.col(f"first.{c}").alias(f"at_{c}") for c in (*PLACE, "line")]
    dropped = stage(counted.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"), "n", *exempt), "line-keys")
    n_keys = dropped.count()

    if n_keys <= KEYS:
        table = dropped.select("h1", "h2", *[f"at_{c}" for c in (*PLACE, "line")]).toPandas()
        order = np.argsort(table["h1"].to_numpy(np.int64), kind="stable")
        sent = docs.sparkSession.sparkContext.broadcast(tuple(table[c].to_numpy(np.int64)[order] for c in table.columns))

        @F.arrow_udf("array<boolean>")
        def lost(h1: pa.Array, h2: pa.Array, file: pa.Array, number: pa.Array) -> pa.Array:
            a, b, offsets = _values(h1), _values(h2), _offsets(h1)
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            line = np.arange(len(a)) - offsets[row]
            k1, k2, f, r, at_line = sent.value
            at = _find(a, b, k1, k2)
            spared = np.zeros(len(a), bool)
            if keep == "first" and len(k1):
                spared = (at >= 0) & (f[at] == file.to_numpy(zero_copy_only=False)[row]) & (r[at] == number.to_numpy(zero_copy_only=False)[row]) & (at_line[at] == line)
            return _marks(offsets, (at >= 0) & ((a != 0) | (b != 0)) & ~spared)

        judged = known.withColumn("lost", lost(first_hash, second_hash, *[F.col(c) for c in PLACE]))
    else:
        hits = attach(each.select(*PLACE, "line", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2")), dropped, ["h1", "h2"], "n").filter("n is not null")
        spared_line = F.when((F.col(f"at_{PLACE[0]}") == F.col(PLACE[0])) & (F.col(f"at_{PLACE[1]}") == F.col(PLACE[1])) & (F.col("at_line") == F.col("line")) & F.lit(keep == "first"), F.col("line")).otherwise(-1)
        by_row = hits.groupBy(*PLACE).agg(F.sort_array(F.collect_list(F.struct("h1", "h2", spared_line.alias("spared")))).alias("own"))  # at most a row's lines

        @F.arrow_udf("array<boolean>")
        def lost_of_row(h1: pa.Array, h2: pa.Array, k1: pa.Array, k2: pa.Array, spared: pa.Array) -> pa.Array:
            a, b, offsets = _values(h1), _values(h2), _offsets(h1)
            own1, own2, spare, own_offsets = _values(k1), _values(k2), _values(spared), _offsets(k1)
            marks = np.zeros(len(a), bool)
            for i in range(len(offsets) - 1):
                x, y = slice(offsets[i], offsets[i + 1]), slice(own_offsets[i], own_offsets[i + 1])
                if y.stop > y.start:
                    at = _find(a[x], b[x], own1[y], own2[y])
                    marks[x] = (at >= 0) & ((a[x] != 0) | (b[x] != 0)) & (spare[y][at] != np.arange(x.stop - x.start))
            return _marks(offsets, marks)

        clean = found.filter(F.size("lines") == 0).select("doc", *PLACE, "keys", F.array().cast("array<boolean>").alias("lost"))
        rest = found.filter(F.size("lines") > 0).drop("lines").join(by_row, list(PLACE), "left").withColumn("own", F.coalesce("own", F.array().cast("array<struct<h1:bigint,h2:bigint,spared:int>>")))
        judged = clean.unionByName(rest.withColumn("lost", lost_of_row(first_hash, second_hash, F.col("own.h1"), F.col("own.h2"), F.col("own.spared").cast("array<bigint>"))).drop("own"))
    n_lost = F.size(F.filter("lost", lambda x: x))
    left = F.when(n_lost == 0, F.coalesce("doc.text", F.lit(""))).otherwise(F.array_join(F.filter(lines, lambda _, i: ~F.get("lost", i)), "\n"))
    text = [(left if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns]
    return judged.select(*text, F.size("keys").cast("long").alias(names[0]), n_lost.cast("long").alias(names[1]))


def digests(docs: DataFrame, min_chars: int = 1, min_docs: int = 10) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row."""
    return dedup_lines(docs.select("doc_id", "text"), min_chars, min_docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def oracle_sql(min_chars: int = 1, min_docs: int = 10) -> str:
    """DuckDB SQL for digests()'s rows."""
    space = " || ".join(f"chr({ord(c)})" for c in SPACE)
    return f"""
WITH numbered AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each AS (SELECT row, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS line_no FROM numbered),
keyed AS (SELECT *, translate(trim(line, {space}), '{UPPER}', '{LOWER}') AS key FROM each),
repeated AS (SELECT key FROM keyed WHERE length(key) >= {min_chars} GROUP BY key HAVING count(DISTINCT row) >= {min_docs}),
judged AS (SELECT k.*, r.key IS NOT NULL AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY row
"""
