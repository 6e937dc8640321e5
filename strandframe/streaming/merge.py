"""Histograms of a stream of reads.

Sums by key are associative, so each micro-batch is counted like a table and its counts are put beside those before;
readers add them up. There is no event time, hence no watermark. A batch that is run again after a failure replaces
its own folder, so counts stay exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strandframe.model import BitVectorConfig
from strandframe.operators import filters, histogram, vectors


def count_stream(reads: DataFrame, refs: DataFrame, folder: str, checkpoint: str, config: BitVectorConfig = BitVectorConfig(), available_now: bool = True) -> StreamingQuery:
    """Write each micro-batch's tallies below folder; reads: a streaming DataFrame of aligned reads."""

    def count(batch: DataFrame, number: int) -> None:
        judged = filters.with_reason(vectors.single_fragments(batch, refs, config, lazy=True), config)
        histogram.tallies(judged).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    writer = reads.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def merged(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """positions, mutation_counts and read_counts of all batches so far."""
    parts = spark.read.parquet(folder).drop("batch")
    return histogram.merge_positions([histogram.of_positions(parts)]), histogram.merge_mutation_counts([histogram.of_mutations(parts)]), histogram.of_reads(parts)
