"""Exact percentiles and distances of distributions for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglattice.operators.asof import in_order


def exact_percentile(df: DataFrame, keys: Sequence[str], value: str, q: float, name: str) -> DataFrame:
    """Per key the least value that at least the share ``q`` of the key's non-null values does not exceed.

    Equal values are counted first. The counts are range-partitioned by key and value, so a key with many values lies in several parts; each part
    adds up its own counts, and what a key's earlier parts hold is one row per part. No task sees more than one part of a key. Keys without a value
    have no row; a null key is a key.
    """
    if not 0 < q <= 1:
        raise ValueError("q must be above 0 and at most 1")
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    parts = in_order(counts, [*keys, value])
    sums = parts.groupBy(*keys, "part").agg(F.sum("__n").alias("held"))
    own = Window.partitionBy(*keys)
    earlier = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part that holds some of the key
    before, total = F.coalesce(F.sum("held").over(earlier), F.lit(0)), F.sum("held").over(own)
    sums = sums.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("part").alias("__part"), "held", before.alias("before"), F.ceil(total.cast("decimal(20,0)") * F.lit(Decimal(str(q)))).alias("rank"))
    # Of each key only the part that holds the rank goes on.
    chosen = sums.where((F.col("before") < F.col("rank")) & (F.col("before") + F.col("held") >= F.col("rank")))
    same = F.col("part") == F.col("__part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    inside = Window.partitionBy(*keys).orderBy(value)
    ranked = parts.join(chosen, same).withColumn("upto", F.col("before") + F.sum("__n").over(inside))
    return ranked.where("upto >= rank").groupBy(*keys).agg(F.min(value).alias(name))


def running_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per key and distinct non-null value: its number ``n``, that of values up to it ``upto``, and of all the key's values ``total``.

    Counted per part of a range partitioning, as in ``exact_percentile``. Without keys all rows are one group.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    parts = in_order(counts, [*keys, value])
    own = Window.partitionBy(*keys)
    sums = parts.groupBy(*keys, "part").agg(F.sum("n").alias("held"))
    earlier = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before, total = F.coalesce(F.sum("held").over(earlier), F.lit(0)), F.sum("held").over(own)
    sums = sums.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("part").alias("__part"), before.alias("before"), total.alias("total"))
    same = F.col("part") == F.col("__part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    inside = Window.partitionBy(*keys, "part").orderBy(value)
    upto = F.col("before") + F.sum("n").over(inside)
    return parts.join(sums, same).select(*keys, value, "n", upto.alias("upto"), "total")


def distance_from_rest(df: DataFrame, group: str, value: str, chosen: Column | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distances between each group's values and those of all other rows.

    ``above`` is how far the group's distribution lies to the right of the rest's at most, ``below`` how far to the left; ``rest`` and ``n`` are the
    sizes. ``chosen`` limits the groups that are compared, not the rest. Both distributions are steps, so only the group's own values, and what
    lies just before them, can be extremes. Rows with a null value are left out, rows with a null group belong to the rest only.
    """
    everyone = running_counts(df, [], value).select(value, F.col("upto").alias("all_upto"), F.col("n").alias("all_n"), F.col("total").alias("all_total"))
    members = df.where(F.col(group).isNotNull())
    own = running_counts(members if chosen is None else members.where(chosen), [group], value)
    both = own.join(everyone, value).withColumn("rest", F.col("all_total") - F.col("total"))
    at = F.col("upto") / F.col("total") - (F.col("all_upto") - F.col("upto")) / F.col("rest")
    ahead = F.col("upto") - F.col("n")
    just_before = ahead / F.col("total") - (F.col("all_upto") - F.col("all_n") - ahead) / F.col("rest")
    return both.where("rest > 0").groupBy(group).agg(
        F.max("total").alias("n"), F.max("rest").alias("rest"), F.greatest(F.lit(0.0), F.max(-just_before)).alias("above"), F.greatest(F.lit(0.0), F.max(at)).alias("below"),
    )
