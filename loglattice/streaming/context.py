"""Events around alerts, and bursts, on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglattice.streaming.windows import windowed_counts


def alert_context(
    alerts: DataFrame, events: DataFrame, before_seconds: int = 3600, after_seconds: int = 600, alert_delay: str = "10 minutes",
    event_delay: str = "10 minutes", key: str = "client_ip",
) -> DataFrame:
    """Every event of the same key between ``before_seconds`` before and ``after_seconds`` after an alert: the two streams' rows joined.

    ``alerts`` has ``alert_id, key, alert_ts`` and ``events`` has ``event_id, key, event_ts``; both are streams, or both batches. Rows later than
    their stream's delay are dropped. State is kept per key and time slice and forgotten once both watermarks have passed, so a busy address is
    spread over the slices it is active in; an event takes part in the two slices in which alerts could ask for it.
    """
    width = before_seconds + after_seconds

    def slice_of(seconds):
        return F.floor(seconds / width)

    at, event_at = F.unix_timestamp("alert_ts"), F.unix_timestamp("event_ts")
    left = alerts.where(F.col(key).isNotNull()).withColumn("slice", slice_of(at)).withWatermark("alert_ts", alert_delay)
    # An alert reaches from ``before`` ahead of it to ``after`` behind it, so its slice is that of the event less ``after``, or a later one.
    reach = F.array_distinct(F.array(slice_of(event_at - after_seconds), slice_of(event_at + before_seconds)))
    right = events.where(F.col(key).isNotNull()).withWatermark("event_ts", event_delay)
    right = right.select(F.col(key).alias("__key"), *[c for c in events.columns if c != key], F.explode(reach).alias("__slice"))
    near = F.expr(f"event_ts >= alert_ts - INTERVAL {before_seconds} SECONDS AND event_ts <= alert_ts + INTERVAL {after_seconds} SECONDS")
    both = left.join(right, (F.col(key) == F.col("__key")) & (F.col("slice") == F.col("__slice")) & near)
    return both.select(*alerts.columns, *[c for c in events.columns if c != key])


def context_counts(pairs: DataFrame) -> DataFrame:
    """Per alert: events around it, those before it, and the first and last of them; a batch over the stored pairs."""
    return pairs.groupBy("alert_id", "client_ip", "alert_ts").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_ts") < F.col("alert_ts")).alias("n_before"),
        F.min("event_ts").alias("first_ts"), F.max("event_ts").alias("last_ts"),
    )


def status_bursts(
    events: DataFrame, threshold: int, delay: str = "10 minutes", size: str = "5 minutes", slide: str | None = None,
    statuses: Sequence[int] = (401, 403, 429),
) -> DataFrame:
    """As ``detect.status_burst`` on a stream: windows in which an address collects ``threshold`` refused requests, once they are closed."""
    refused = events.where(F.col("client_ip").isNotNull() & F.col("http_status").isin(*statuses))
    return windowed_counts(refused, ["client_ip"], delay, size, slide).where(F.col("n") >= threshold)
