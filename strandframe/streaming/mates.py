"""Mates of a stream of aligned reads: a read waits for its mate across micro-batches, for a time."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strandframe.operators.vectors import is_primary

_STATE = "waiting binary"


def wait_on_disk(spark: SparkSession, memory_mb: int = 500) -> None:
    """Keep the state of streams that start after this in RocksDB, on the executors' disks: what waits may be larger than
    their memory, of which all states of an executor share at most so many MB. By default Spark keeps it in the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", str(memory_mb))
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def fragments_of_stream(stream: DataFrame, wait_seconds: int, time_col: str = "seen", mate_col: str = "mate", buckets: int = 1024) -> DataFrame:
    """A stream of (qname, r1, r2, n1, n2), as operators.vectors.fragments_by_name() gives them: pairs_of() and orphans_of()
    read pairs and orphans off it, as off a batch.

    A name is settled when the stream's time (the latest in ``time_col``) has passed its last line by ``wait_seconds`` (1 at
    least): only then is it known that no further line makes a pair of an orphan, or undoes a pair. Until then lines may come
    in any order; later ones are left out, or are a name of their own. So however the reads are cut into micro-batches,
    names whose lines are that near to each other come out as from the batch operator. A row without a name only moves the
    time on: the last row of a stream that ends should be one.

    What is kept is the names not yet settled, two lines each, in ``buckets`` by a hash of the name, compressed: a call for
    each bucket instead of each name. A bucket's names are written anew when one comes, so there should be so many buckets
    that a few hundred names wait in each. All columns of the stream move and wait, so it should have those alone that are
    needed.
    """
    columns = [c for c in stream.columns if c not in (mate_col, time_col)]
    short = {c: f"c{i}" for i, c in enumerate(columns) if c != "qname"}  # the name moves beside them
    kind = T.StructType([T.StructField(n, stream.schema[c].dataType) for c, n in short.items()])
    read = F.to_json(F.struct(*[F.col(c).alias(n) for c, n in short.items()])) if short else F.lit("{}")
    lines = stream.filter(F.col("qname").isNull() | is_primary(stream)).withWatermark(time_col, f"{wait_seconds} seconds")
    lines = lines.select(F.pmod(F.xxhash64("qname"), F.lit(buckets)).alias("bucket"), "qname", F.col(mate_col).cast("int").alias("m"), F.col(time_col), read.alias("read"))

    def settle(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting: dict[str, list] = {}
        if state.exists:
            waiting = json.loads(zlib.decompress(state.get[0]))
        for batch in batches:
            times = batch[time_col].astype("datetime64[ms]").astype("int64")
            for name, m, seen, line in zip(batch["qname"], batch["m"], times, batch["read"], strict=True):
                if name is not None:
                    own = waiting.setdefault(name, [None, None, 0, 0, 0])
                    own[4] = max(own[4], int(seen))
                    if m in (1, 2):
                        own[m - 1] = line if own[m - 1] is None else own[m - 1]
                        own[m + 1] += 1
        now = state.getCurrentWatermarkMs()
        done = [(name, *own[:4]) for name, own in waiting.items() if own[4] < now]
        for name, *_ in done:
            del waiting[name]
        if waiting:
            state.update((zlib.compress(json.dumps(waiting, separators=(",", ":")).encode(), 1),))
            state.setTimeoutTimestamp(max(min(own[4] for own in waiting.values()), now + 1))
        elif state.exists:
            state.remove()
        if done:
            yield pd.DataFrame(done, columns=["qname", "j1", "j2", "n1", "n2"])

    out = lines.groupBy("bucket").applyInPandasWithState(settle, "qname string, j1 string, j2 string, n1 long, n2 long", _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    parsed = out.select("*", *[F.from_json(f"j{m}", kind).alias(f"p{m}") for m in (1, 2)])
    whole = [F.when(F.col(f"j{m}").isNotNull(), F.struct(*[F.col(f"p{m}.{short[c]}").alias(c) if c in short else F.col(c) for c in columns])).alias(f"r{m}") for m in (1, 2)]
    return parsed.select("qname", *whole, "n1", "n2")
