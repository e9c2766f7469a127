"""Intervals to disjoint segments, and as-of look-ups over one global order, without a bucket join.

Both work on range partitions. What passes from one partition to the next, a count or the segment still open, is one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglattice.session import stored

_PLACE_BITS = 33
#: Levels of the segment tree, from the top, that hold at most 2 ** (this + 1) blocks and are broadcast.
_TOP_LEVELS = 10
#: Rows that one task makes of its intervals or bounds, and sorts, before they are united.
_TASK_ROWS = 1 << 20


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Stored rows with ``part``, the range partition, and ``place`` within it."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    place = F.col("at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return stored(rows.withColumn("part", F.shiftright("at", _PLACE_BITS)).withColumn("place", place).drop("at"), "in-order")


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Rows with their position from zero in a total order."""
    rows = in_order(df, order)
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a partition
    offsets = sizes.select("part", before.alias("before"))
    return rows.join(F.broadcast(offsets), "part").withColumn(name, F.col("before") + F.col("place")).drop("part", "place", "before")


def _blocks(a: Column, b: Column, levels: int) -> Column:
    """The blocks of halving size that make up the ranks from ``a`` up to before ``b``: at most two a level."""
    start = F.struct(a.alias("a"), b.alias("b"), F.array().cast("array<struct<level:int,block:bigint>>").alias("out"))

    def step(s: Column, level: Column) -> Column:
        one = F.lit(1).cast("bigint")
        odd_a = (s["a"] < s["b"]) & (s["a"].bitwiseAND(one) == 1)
        next_a = s["a"] + F.when(odd_a, 1).otherwise(0)
        odd_b = (next_a < s["b"]) & (s["b"].bitwiseAND(one) == 1)
        next_b = s["b"] - F.when(odd_b, 1).otherwise(0)
        taken = [F.when(odd, F.struct(level.alias("level"), block.alias("block"))) for odd, block in ((odd_a, s["a"]), (odd_b, next_b))]
        halved = [F.shiftright(x, 1) for x in (next_a, next_b)]
        return F.struct(halved[0].alias("a"), halved[1].alias("b"), F.concat(s["out"], F.array_compact(F.array(*taken))).alias("out"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, step)["out"]


def _tasks(df: DataFrame, rows: int, each: int) -> int:
    """Tasks for the ``rows`` of ``df`` that become up to ``each`` rows, so that what a task sorts does not grow with the input."""
    return max(-(-rows * each // _TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism)


def disjoint_segments(intervals: DataFrame) -> DataFrame:
    """Overlapping ``intervals(seq, start_ts, end_ts, phase)``, both bounds inclusive, to ``(t, hit)``: from ``t`` on, in microseconds, ``hit`` holds.

    ``hit`` is the (seq, phase) of the lowest seq whose interval covers the time, or null in a gap; it holds up to the next ``t``. Intervals with
    a null or reversed bound cover nothing. The bounds are numbered in order; each interval gives its seq to the blocks of a binary tree over
    these numbers, and each segment takes the lowest of the blocks above it, so a time that many intervals cover costs no more than another.
    Of intervals with equal bounds only the lowest counts. Work is dealt in tasks of ``_TASK_ROWS`` rows.
    """
    lo, hi = F.unix_micros(F.col("start_ts").cast("timestamp")), F.unix_micros(F.col("end_ts").cast("timestamp")) + 1
    spans = intervals.select(F.struct("seq", "phase").alias("hit"), lo.alias("lo"), hi.alias("hi")).where("lo < hi")
    spans = stored(spans.groupBy("lo", "hi").agg(F.min("hit").alias("hit")), "spans")
    points = stored(numbered(spans.select(F.explode(F.array("lo", "hi")).alias("t")).distinct(), ["t"], "rank"), "bounds")
    n_points = points.count()
    levels = max(n_points, 1).bit_length()
    ends = [points.select(F.col("t").alias(t), F.col("rank").alias(r)) for t, r in (("lo", "a"), ("hi", "b"))]
    placed = stored(spans.join(ends[0], "lo").join(ends[1], "hi").select("a", "b", "hit"), "placed")
    near = placed.repartitionByRange(_tasks(placed, placed.count(), 2 * levels), "a", "b")
    held = near.select("hit", F.explode(_blocks(F.col("a"), F.col("b"), levels)).alias("x"))
    best = stored(held.groupBy("x.level", "x.block").agg(F.min("hit").alias("hit")), "blocks")
    dealt = points.repartition(_tasks(points, n_points, levels + 1), "rank")
    above = dealt.select("t", "rank", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")).withColumn("block", F.expr("shiftright(rank, level)"))
    top = F.col("level") >= levels - _TOP_LEVELS
    found = above.where(~top).join(best.where(~top), ["level", "block"]).select("t", "hit")
    found = found.unionByName(above.where(top).join(F.broadcast(best.where(top)), ["level", "block"]).select("t", "hit"))
    none = F.lit(None).cast(best.schema["hit"].dataType).alias("hit")
    return found.unionByName(points.select("t", none)).groupBy("t").agg(F.min("hit").alias("hit"))


def last_before(times: DataFrame, segments: DataFrame) -> DataFrame:
    """Distinct ``times(t)`` with the ``hit`` of the last of the ``segments(t, hit)`` at or before each; null before the first."""
    none = F.lit(None).cast(segments.schema["hit"].dataType)
    rows = segments.select("t", F.lit(0).alias("kind"), "hit").unionByName(times.select("t", F.lit(1).alias("kind"), none.alias("hit")))
    rows = in_order(rows, ["t", "kind"])
    segment = F.when(F.col("kind") == 0, F.struct("hit"))
    closing = rows.where("kind = 0").groupBy("part").agg(F.max_by(F.struct("hit"), "t").alias("last"))
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).join(closing, "part", "left")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    carried = parts.select("part", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    here = Window.partitionBy("part").orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = rows.withColumn("inside", F.last(segment, ignorenulls=True).over(here)).where("kind = 1")
    return inside.join(F.broadcast(carried), "part").select("t", F.coalesce("inside", "carried")["hit"].alias("hit"))
