"""Hourly roll-ups with mergeable distinct counts.

Events are reduced once to one row per key and hour with counts and two HyperLogLog sketches. Days, weeks or any other windows of whole hours unite
these rows, so they need no second read of the events and no expansion per distinct column. Small sets are counted exactly by the sketch itself; the
error of large ones is about 1.04 / sqrt(2 ** LG_K), one standard deviation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglattice.functions.scalars import business_hour
from loglattice.operators.lookup import lookup_join
from loglattice.plans.detect import _addressed, event_probe_tags

LG_K = 12
#: Relative error that an estimate stays within, five standard deviations.
ERROR = 5 * 1.04 / 2 ** (LG_K / 2)
_SUMS = ("events", "refused", "probes", "off_hours", "bytes")


def hourly(events: DataFrame, keys: Sequence[str] = ("client_ip",)) -> DataFrame:
    """One row per key and hour: counts, bytes, and sketches of users and accounts; events without an address are nobody's."""
    return _addressed(events).groupBy(*keys, F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("http_status").isin(401, 403, 429)).alias("refused"),
        F.count_if(F.size(event_probe_tags()) > 0).alias("probes"), F.count_if(~business_hour("ts")).alias("off_hours"), F.sum("bytes").alias("bytes"),
        F.hll_sketch_agg("user_name", F.lit(LG_K)).alias("users"), F.hll_sketch_agg("account_id", F.lit(LG_K)).alias("accounts"),
    )


def united(rollup: DataFrame, keys: Sequence[str], window: Column, name: str = "window") -> DataFrame:
    """The hourly rows over longer windows: ``window`` is an expression of ``hour``; distinct counts are estimates."""
    estimates = [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in ("users", "accounts")]
    return rollup.groupBy(*keys, window.alias(name)).agg(*[F.sum(c).alias(c) for c in _SUMS], *estimates)


def daily(rollup: DataFrame, keys: Sequence[str] = ("client_ip",)) -> DataFrame:
    return united(rollup, keys, F.to_date("hour"), "day")


def at_least(rollup: DataFrame, events: DataFrame, column: str, value: str, minimum: int, window: Column, keys: Sequence[str] = ("client_ip",)) -> DataFrame:
    """Keys and windows with ``minimum`` distinct ``value``s or more: ``keys, window, n, exact``.

    The sketches decide where the estimate is further from the minimum than its error; only the windows near it are counted from the events. ``n``
    is the estimate in the first case and the number in the second.
    """
    sized = rollup.groupBy(*keys, window.alias("window")).agg(F.hll_sketch_estimate(F.hll_union_agg(column)).alias("estimate"))
    near = sized.where(F.abs(F.col("estimate") - minimum) <= ERROR * minimum)
    sure = sized.where(F.col("estimate") - minimum > ERROR * minimum).select(*keys, "window", F.col("estimate").alias("n"), F.lit(False).alias("exact"))
    placed = _addressed(events).where(F.col(value).isNotNull()).withColumn("hour", F.date_trunc("hour", "ts")).select(*keys, window.alias("window"), value)
    open_ones = lookup_join(placed, near.select(*keys, "window"), [*keys, "window"], "inner")
    counted = open_ones.groupBy(*keys, "window").agg(F.count_distinct(value).alias("n")).where(F.col("n") >= minimum)
    return sure.unionByName(counted.withColumn("exact", F.lit(True)))
