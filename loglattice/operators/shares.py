"""Counts, shares and dataset profiles.

Totals are scalar subqueries or joins on the aggregated groups, so no window ever gathers all groups in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share_of_total(df: DataFrame, *keys: str) -> DataFrame:
    """``n`` and ``share`` of all rows per group."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def share_in_parent(df: DataFrame, parent: str, child: str) -> DataFrame:
    """``n`` per (parent, child) and its share within the parent; 0 for an empty parent."""
    counts = df.groupBy(parent, child).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(F.col(parent).alias("__parent")).agg(F.sum("n").alias("__total"))
    return counts.join(totals, F.col(parent).eqNullSafe(F.col("__parent"))).select(
        parent, child, "n", F.when(F.col("__total") > 0, F.col("n") / F.col("__total")).otherwise(0.0).alias("share")
    )


def conditional_share(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row: rows ``checked``, and per condition its count and percentage of the rows."""
    found = df.agg(
        F.count(F.lit(1)).alias("checked"), *[F.count_if(c).cast("bigint").alias(n) for n, c in conditions.items()]
    )
    pct = {
        f"{n}_pct": F.round(F.col(n) * 100 / F.greatest(F.lit(1), F.col("checked")), 4) for n in conditions
    }
    return found.withColumns(pct)


def profile(df: DataFrame, ts: str, text: str | None = None, distinct: Mapping[str, str] | None = None,
            approximate: bool = False) -> DataFrame:
    """One row: rows, columns, raw bytes, time window and distinct counts."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    raw = F.sum(F.octet_length(text)).alias("raw_bytes") if text else F.lit(None).cast("bigint").alias("raw_bytes")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        raw,
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        *[count(c).alias(n) for n, c in (distinct or {}).items()],
    )


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a defined order."""
    return df.orderBy(*order).limit(n)


def time_sorted(df: DataFrame, ts: str, *ties: str, partitions: int | None = None) -> DataFrame:
    """Globally sorted by time: ranges per partition, each sorted; ties spread a crowded instant."""
    keys = [ts, *ties]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)
