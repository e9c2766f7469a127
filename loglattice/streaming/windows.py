"""Windowed counts and sessions on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_counts(
    stream: DataFrame, keys: Sequence[str], watermark: str = "10 minutes", size: str = "5 minutes",
    slide: str | None = None, ts: str = "ts",
) -> DataFrame:
    """Events per key and tumbling or sliding window; rows later than the watermark are dropped."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    counted = stream.withWatermark(ts, watermark).groupBy(*keys, window.alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")


def sessions(
    stream: DataFrame, keys: Sequence[str], gap: str = "30 minutes", watermark: str | None = "10 minutes", ts: str = "ts"
) -> DataFrame:
    """Sessions of activity per key, closed after ``gap`` without events. Works on a batch input as well."""
    source = stream.withWatermark(ts, watermark) if watermark else stream
    counted = source.groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def store(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append finished windows to Parquet."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def with_open_windows(stored: DataFrame, counted: DataFrame, count: str = "n") -> DataFrame:
    """The stored windows of a bounded stream, and those still open when it ended, ``counted`` from the same input as a batch.

    A grouping tells them apart: filters and anti joins on a window would be pushed below the merging of sessions.
    """
    names = [c for c in stored.columns if c != count]
    both = stored.withColumn("__open", F.lit(1)).unionByName(counted.withColumn("__open", F.lit(2)))
    return both.groupBy(*names).agg(F.min_by(count, "__open").alias(count)).select(*stored.columns)
