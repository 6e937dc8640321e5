"""What the operators of this subpackage share: staging of intermediate tables, the train/held-out split, size-checked
broadcasts, keys of rows, and bounded batches."""

from __future__ import annotations

import bisect
import contextlib
import ctypes
import gc
import itertools
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandframe.session import shared_dir, stage

__all__ = ["BATCH_ROWS", "BROADCAST_BYTES", "HOT_SHARE", "PLACE", "attach", "by_ranges", "give_back", "held_out", "placed", "shared_dir", "slices", "small", "small_batches", "stage"]

#: Size in a hash table up to which a key table may be broadcast; past that Spark chooses the join by its own threshold.
BROADCAST_BYTES = 16_000_000
#: The columns that placed() adds.
PLACE = ("strandframe_file", "strandframe_row")
#: Rows that go to Python at once.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> SparkSession:
    """Let rows go to Python ``BATCH_ROWS`` at a time, unless the session asks for fewer: a batch of long texts takes its
    size several times over, in the JVM and in Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves the remainder 0 modulo 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def small(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df, of columns of fixed width, with a broadcast hint if its hash table takes ``limit`` bytes at most, by its
    number of rows (counted, unless given); else as it is."""
    if any(isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)) for f in df.schema):
        return df  # of no known width
    if rows is None:
        rows = df.count()
    return F.broadcast(df) if rows * (32 + 8 * len(df.columns)) <= limit else df


def _is_scan(docs: DataFrame) -> bool:
    """Whether docs are rows of one set of files, each once: columns chosen and rows left out, but nothing joined,
    repeated or put together, and no path named twice or below another."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.children().size() == 1 and plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    if plan.children().size() or not plan.nodeName().startswith("LogicalRelation"):
        return False
    try:
        found = plan.relation().location().rootPaths()
    except Py4JError:  # a relation that isn't of files
        return False
    roots = sorted(found.apply(i).toString().rstrip("/") + "/" for i in range(found.size()))
    return all(not b.startswith(a) for a, b in itertools.pairwise(roots))


def placed(docs: DataFrame, name: str) -> DataFrame:
    """docs with the columns ``PLACE``: a hash of the file and the number of the row in it, which tell each row from all
    others, whatever ids are null or shared, and are the same each time the files are read.

    Rows that don't come straight from files (after a join, say, or a path named twice) are staged first.
    """
    if _is_scan(docs):
        with contextlib.suppress(AnalysisException):  # files without row numbers, such as CSV
            own = docs.metadataColumn("_metadata")
            return docs.select("*", F.xxhash64(own["file_path"]).alias(PLACE[0]), own["row_index"].alias(PLACE[1]))
    staged = stage(docs, name, "zstd")
    own = staged.metadataColumn("_metadata")
    return staged.select("*", F.xxhash64(own["file_path"]).alias(PLACE[0]), own["row_index"].alias(PLACE[1]))


#: A key is hot if more than one of so many rows has it; there are fewer hot keys than that.
HOT_SHARE = 4000


def attach(rows: DataFrame, table: DataFrame, keys: list[str], count: str) -> DataFrame:
    """rows with the other columns of table, null where it lacks the key. table: staged, columns of fixed width, one row for
    each key, with ``count``, the number of rows that have it. Equal nulls meet.

    A key may have any share of the rows. A small table is broadcast; else its hot keys are, of which there are fewer than
    ``HOT_SHARE``, and rows that have met one go through the shuffle dealt out by all their columns.
    """
    renamed = table.select(*[F.col(k).alias(f"key_{k}") for k in keys], *[c for c in table.columns if c not in keys])
    own = [c for c in table.columns if c not in keys]
    on = [F.col(k).eqNullSafe(F.col(f"key_{k}")) for k in keys]
    known, total = table.agg(F.count("*"), F.sum(count)).first()
    near = small(renamed, known)
    if near is not renamed or not known:
        return rows.join(near, on, "left").drop(*[f"key_{k}" for k in keys])
    hot, cold = renamed.filter(F.col(count) * HOT_SHARE > total), renamed.filter(F.col(count) * HOT_SHARE <= total)
    met = rows.join(F.broadcast(hot.select(*[c for c in hot.columns if c.startswith("key_")], F.struct(*own).alias("hot_own"))), on, "left").drop(*[f"key_{k}" for k in keys])
    met = met.withColumn("deal", F.when(F.col("hot_own").isNull(), 0).otherwise(F.pmod(F.xxhash64(*rows.columns), F.lit(99991)) + 1))
    both = met.join(cold.select(*[c for c in cold.columns if c.startswith("key_")], F.struct(*own).alias("cold_own"), F.lit(0).cast("long").alias("cold_deal")), [*on, F.col("deal") == F.col("cold_deal")], "left")
    return both.select(*rows.columns, F.coalesce("hot_own", "cold_own").alias("own")).select(*rows.columns, "own.*")


def by_ranges(docs: DataFrame, parts: int) -> tuple[DataFrame, int]:
    """docs (doc_id, text) with ``part``, the number of the range that a row lies in, in the order of (doc_id, text),
    nulls first; and how many ranges: about ``parts``, of about the same number of bytes.

    Spark cuts ids, and the beginnings of texts, into four times as many ranges by rows; neighbours are joined until
    they have their share of the bytes. What the driver holds is the first row of each such range. A row finds its range
    by bisection; only its id and the beginning of its text go to Python. Rows of one id are dealt out by their texts.
    """
    head = F.coalesce(F.substring("text", 1, 24), F.lit(""))
    key = docs.select(F.col("doc_id").isNotNull().alias("known"), "doc_id", head.alias("head"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    fine = key.repartitionByRange(4 * parts, "known", "doc_id", "head").withColumn("fine", F.spark_partition_id())
    cuts = stage(fine.groupBy("fine").agg(F.min(F.struct("known", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "head")).alias("first"), F.sum(F.col("size") + 64).alias("size")), "ranges")
    bounds, gathered, share = [], 0, None
    rows = cuts.orderBy("first").collect()  # 4 * parts rows at most
    share = sum(r["size"] for r in rows) / parts
    for r in rows:
        if gathered >= share:
            bounds.append(tuple(r["first"]))
            gathered = 0
        gathered += r["size"]
    shared = docs.sparkSession.sparkContext.broadcast(bounds)

    @F.arrow_udf("int")
    def number(ids: pa.Array, heads: pa.Array) -> pa.Array:
        cuts_ = shared.value
        return pa.array([bisect.bisect_right(cuts_, (i is not None, i or 0, h)) for i, h in zip(ids.to_pylist(), heads.to_pylist(), strict=True)], pa.int32())

    part = number("doc_id", head) if bounds else F.lit(0)
    return docs.withColumn("part", part), len(bounds) + 1


def give_back() -> None:
    """Give the memory that this process doesn't need back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows (without copying), so that what a task makes of one slice stays small.

    At the end the process gives the memory that it doesn't need back to the machine: Python workers live on between
    tasks, beside each other and the JVM.
    """
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
    finally:
        give_back()
