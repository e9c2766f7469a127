import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from loglattice.operators.lookup import hot_keys, lookup_join


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("fits", [True, False])
def test_skewed_lookup_keeps_every_row(spark, how, fits):
    # Key 1 and the null key hold a third of the rows each; key 2 is large without a right row.
    left = spark.range(9000).select(
        "id", F.expr("case when id % 3 = 0 then 1 when id % 3 = 1 then null when id % 30 = 2 then 2 else id end").alias("k")
    )
    right = spark.range(5000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v")).where("k <> 2")
    out = lookup_join(left, right, ["k"], how, fits=fits, share=20)
    want = left.join(right, "k", how)
    assert out.count() == want.count()
    assert out.exceptAll(want.select(out.columns)).count() == 0


def test_large_keys_are_split_and_each_side_is_planned_once(spark):
    left = spark.range(9000).select(F.expr("case when id % 3 = 0 then 1 else id end").alias("k"))
    assert [tuple(r) for r in hot_keys(left, ["k"], 10).collect()] == [(1, 4)]
    right = spark.range(5000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    text = plan_text(lookup_join(left, right, ["k"], "inner", fits=False))
    assert "NestedLoop" not in text and "Cartesian" not in text
    plain = lookup_join(left, right, ["k"], "left", fits=False, skewed=False)
    assert plain._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 2


@pytest.mark.parametrize("skewed", [True, False])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_empty_sides_and_repeated_rows(spark, how, skewed):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "c")], "k int, t string")
    right = spark.createDataFrame([(1, "x"), (None, "never"), (3, "y")], "k int, v string")
    for one, two in ((left, right), (left.limit(0), right), (left, right.limit(0))):
        got = lookup_join(one, two, ["k"], how, fits=False, share=2, skewed=skewed)
        assert sorted(map(str, got.collect())) == sorted(map(str, one.join(two, ["k"], how).collect()))
