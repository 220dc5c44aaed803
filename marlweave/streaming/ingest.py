"""Streaming ingestion: documents that arrive late or twice, and counts per window. An extension; the batch operators don't need it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def deduplicated(stream: DataFrame, key: str, time: str, late: str = "7 days") -> DataFrame:
    """The first delivery of each key; state is kept as long as a delivery may be late."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed(stream: DataFrame, time: str, by: str, width: str, late: str = "7 days") -> DataFrame:
    """(start, by, n): rows per window and key."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def upserting(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hands each micro-batch to a batch writer, which must be idempotent by its number; processes what is there and stops."""
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
