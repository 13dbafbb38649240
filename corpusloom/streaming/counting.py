"""Chunk counts that are kept up to date as documents arrive."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.pretokenize import explode_chunks
from corpusloom.streaming.encoding import AVAILABLE_NOW

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_counting(
    docs: DataFrame,
    pattern: str | None,
    checkpoint: str,
    text: str = "text",
    partitions: int | None = None,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
) -> StreamingQuery:
    """Count the chunks of a stream of documents; by default, of those available now.

    ``partitions`` spreads documents that arrive in few files.

    The counts live in the state store below ``checkpoint``, one entry per
    distinct chunk; restarting with the same folder goes on from there. The
    session is set to keep state in RocksDB, off the heap of the executors.
    """
    docs.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if partitions:
        docs = docs.repartition(partitions)
    return (
        explode_chunks(docs, pattern, text)
        .groupBy("chunk")
        .agg(F.count("*").alias("cnt"))
        .writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def counted_chunks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The counts ``(chunk, cnt)`` so far, read from the state store by the executors."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(F.col("key.chunk").alias("chunk"), F.col("value.count").alias("cnt"))
