"""Operators over one global order: disjoint segments, as-of look-ups, exact percentiles, change points with silence."""

import math
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from loglattice.operators import asof, joins, quantiles
from loglattice.plans import detect

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
IV = "seq long, start_ts timestamp, end_ts timestamp, phase string"


def at(minute):
    return None if minute is None else T0 + timedelta(minutes=minute)


def tagged(spark, times, intervals):
    events = spark.createDataFrame([(i, at(t)) for i, t in enumerate(times)], "id int, ts timestamp")
    table = spark.createDataFrame([(s, at(a), at(b), p) for s, a, b, p in intervals], IV)
    got = joins.tag_intervals(events, table, ["id"], max_listed=0).collect()
    assert all(r["in_any"] == (r["phase"] is not None) for r in got) and len(got) == len(times)
    return {r["id"]: r["phase"] for r in got}


def brute(times, intervals):
    out = {}
    for i, t in enumerate(times):
        held = [(s, p) for s, a, b, p in intervals if None not in (a, b, t) and a <= t <= b]
        out[i] = min(held)[1] if held else None
    return out


@pytest.mark.parametrize("seed", range(3))
def test_overlapping_intervals_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    intervals = [(i, a := rng.randrange(300), a + rng.choice([0, 1, 7, 90, -3]), f"p{i}") for i in range(120)] + [(500, 50, 60, "crowded")] * 3
    intervals += [(1000 + i, 100, 110, f"q{i}") for i in range(60)] + [(900, None, 5, "x"), (901, 5, None, "y")]
    rng.shuffle(intervals)
    times = [rng.randrange(-10, 420) for _ in range(300)] + [None, 100, 110, 111, 100, 100]
    assert tagged(spark, times, intervals) == brute(times, intervals)


def test_bounds_are_inclusive_and_gaps_stay_empty(spark):
    intervals = [(2, 10, 20, "b"), (1, 20, 30, "a"), (3, 40, 40, "c")]
    times = [9, 10, 19, 20, 21, 30, 31, 39, 40, 41]
    assert list(tagged(spark, times, intervals).values()) == [None, "b", "b", "a", "a", "a", None, None, "c", None]
    assert set(tagged(spark, times, []).values()) == {None}


def test_segments_do_not_overlap_and_no_bucket_is_joined(spark):
    table = spark.range(3000).select(
        F.col("id").alias("seq"), F.timestamp_seconds(F.col("id") % 700 * 10).alias("start_ts"), F.timestamp_seconds(F.col("id") % 700 * 10 + F.col("id")).alias("end_ts"),
        F.concat(F.lit("p"), F.col("id")).alias("phase"),
    )
    rows = sorted((r["t"], r["hit"] and r["hit"]["seq"]) for r in asof.disjoint_segments(table).collect())
    assert len({t for t, _ in rows}) == len(rows) and rows[-1][1] is None
    for t, seq in rows[::97]:
        assert seq == min((i for i in range(3000) if (i % 700) * 10**7 <= t <= ((i % 700) * 10 + i) * 10**6), default=None)


def test_last_before_carries_the_open_segment_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        segments = spark.createDataFrame([(0, ("a",)), (10, None), (5000, ("b",))], "t long, hit struct<x:string>")
        got = {r["t"]: r["hit"] and r["hit"]["x"] for r in asof.last_before(spark.range(-5, 9000).select(F.col("id").alias("t")), segments).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {t: None if t < 0 or 10 <= t < 5000 else "a" if t < 10 else "b" for t in range(-5, 9000)}


def test_numbers_are_dense_and_in_order(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"))
    got = sorted((r["v"], r["n"]) for r in asof.numbered(rows, ["v"], "n").collect())
    assert [n for _, n in got] == list(range(5000))


@pytest.mark.parametrize("q", [0.01, 0.5, 0.95, 1.0])
def test_percentile_of_a_hot_key_is_exact(spark, q):
    rng = random.Random(3)
    rows = [("hot", round(rng.lognormvariate(5, 2), 2)) for _ in range(12_000)] + [(f"k{i % 40}", float(i % 17)) for i in range(900)]
    rows += [("one", 5.0), ("none", None), (None, 2.0), (None, 1.0), ("hot", None)]
    got = {r["k"]: r["p"] for r in quantiles.exact_percentile(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", q, "p").collect()}
    want = {}
    for key in {k for k, _ in rows}:
        values = sorted(v for k, v in rows if k == key and v is not None)
        if values:
            want[key] = values[max(0, math.ceil(round(q * len(values), 9)) - 1)]
    assert got == want


def test_percentile_of_one_key_uses_several_parts(spark):
    df = spark.range(20_000).select(F.lit("k").alias("k"), (F.col("id") * 7919 % 20_011).alias("v"))
    parts = asof.in_order(df.groupBy("k", "v").count(), ["k", "v"])
    assert parts.select("part").distinct().count() >= 1 and "SinglePartition" not in plan_text(parts)
    values = sorted(i * 7919 % 20_011 for i in range(20_000))
    assert quantiles.exact_percentile(df, ["k"], "v", 0.95, "p").first()["p"] == values[19_000 - 1]


def brute_change(buckets, width):
    lo, hi = min(buckets), max(buckets)
    count = lambda a, b: sum(a <= x <= b for x in buckets)
    gaps = [(-abs(count(b, b + width - 1) - count(b - width, b - 1)), b) for b in range(lo + width, hi - width + 2)]
    return (min(gaps)[1], -min(gaps)[0] / width) if gaps else None


@pytest.mark.parametrize("case", ["late burst", "both ends", "random", "short", "single"])
def test_change_points_with_silent_stretches(spark, case):
    rng = random.Random(8)
    series = {
        "late burst": [[0, 50] + [100] * 100], "both ends": [[0, 100]], "short": [[0, 3]], "single": [[7] * 5],
        "random": [sorted(rng.choices(range(0, 400, rng.choice([1, 7, 40])), k=rng.choice([3, 12, 60]))) for _ in range(25)],
    }[case]
    rows = [(str(i), T0 + timedelta(seconds=60 * b)) for i, s in enumerate(series) for b in s]
    got = {r["k"]: (r["bucket"] - int(T0.timestamp()) // 60, r["gap"]) for r in detect.change_points(spark.createDataFrame(rows, "k string, ts timestamp"), ["k"], 60, 5).collect()}
    assert got == {str(i): w for i, s in enumerate(series) if (w := brute_change(s, 5))}
