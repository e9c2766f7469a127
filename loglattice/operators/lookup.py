"""Look-up joins that hold when one key carries much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglattice.session import BROADCAST_BYTES, fits_broadcast

#: A key with at least this fraction (1/n) of the rows is split; there can be at most n such keys.
HOT_SHARE = 1000


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """The at most ``share`` keys that hold 1/``share`` of the rows or more, and the parts of about that size they make."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    parts = F.ceil(F.col("__n") * share / total).cast("int")
    return counts.where(F.col("__n") * share >= total).select(*keys, parts.alias("__parts"))


def lookup_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", fits: bool | None = None,
    max_bytes: int = BROADCAST_BYTES, share: int = HOT_SHARE, skewed: bool = True,
) -> DataFrame:
    """Join ``left`` to ``right``, which has at most one row per key (``how`` is ``left`` or ``inner``).

    A right side whose measured size allows it is broadcast. Otherwise both sides are shuffled once: the few keys that dominate ``left``
    are found from its keys alone and split into parts, their right rows are repeated once per part, which makes at most 2 ``share`` rows,
    and rows without a key are dealt out evenly. The part follows from the task, so a repeated task makes the same parts. ``fits`` passes
    on a size check made earlier; ``skewed=False`` saves the search where no key can be frequent.
    """
    if fits if fits is not None else fits_broadcast(right, max_bytes):
        return left.join(F.broadcast(right), list(keys), how)
    has_key = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    rows = left.where(has_key) if how == "inner" else left
    part, task = F.lit(0), F.spark_partition_id()
    right = right.withColumn("__part", part)
    if skewed:
        hot = F.broadcast(hot_keys(left.where(has_key), keys, share))
        parts = F.coalesce("__parts", F.lit(1))
        rows = rows.join(hot, list(keys), "left")
        right = right.join(hot, list(keys), "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
        part = F.pmod(task, parts)
    rows = rows.withColumn("__part", F.when(has_key, part).otherwise(task)).drop("__parts")
    return rows.join(right, [*keys, "__part"], how).drop("__part")
