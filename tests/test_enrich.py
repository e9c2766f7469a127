from datetime import datetime, timedelta, timezone

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from loglattice.operators import enrich as E

DOC = "_id string, _index string, client_ip string, source_ip string, host_ip string, event_ts timestamp"
HR = "ip_address string, first_name string, last_name string, department string, sub_department string, start_date string"
T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def docs(spark, *rows):
    return spark.createDataFrame([(str(i), "ix", *r[:3], r[3] if len(r) > 3 else T0) for i, r in enumerate(rows)], DOC)




@pytest.fixture(scope="module")
def people(spark):
    rows = [("10.0.0.1", "A"), ("10.0.0.2", "B"), ("10.0.0.2", "AA"), ("bad", "X"), ("", "Y")]
    return spark.createDataFrame([(ip, "F", n, f"dept-{n}", "sub", "2020-01-01") for ip, n in rows], HR)


@pytest.mark.parametrize("strategy", ["broadcast", "join"])
def test_first_matching_column_wins(spark, people, strategy):
    data = docs(
        spark,
        ("10.9.9.9", "10.0.0.1", "10.0.0.2"),  # source before host
        ("10.0.0.2", "10.0.0.1", None),  # client first; tie on the roster: lowest last name
        ("", "", ""),
        (None, None, "bad"),
        ("10.9.9.9", None, "10.0.0.1"),
    )
    out = {r._id: (r.match_rank, r.person and r.person.last_name) for r in E.ranked_lookup(data, people, strategy=strategy).collect()}
    assert out == {"0": (2, "A"), "1": (1, "AA"), "2": (None, None), "3": (None, None), "4": (3, "A")}
    assert "BroadcastNestedLoopJoin" not in plan_text(E.ranked_lookup(data, people, strategy=strategy))


def test_size_check_picks_the_strategy(spark, people):
    data = docs(spark, ("10.0.0.1", None, None))
    assert "BroadcastHashJoin" in plan_text(E.ranked_lookup(data, people))
    small = E.ranked_lookup(data, people, max_bytes=10)
    assert "Generate inline" in plan_text(small) and small.first().match_rank == 1


@pytest.mark.parametrize("strategy", ["broadcast", "join"])
def test_any_match_in_range(spark, people, strategy):
    end = T0 + timedelta(days=1)
    data = docs(
        spark,
        ("10.0.0.2", "10.0.0.1", None, T0),  # two employees: lowest address wins
        (None, None, "10.0.0.2", end),
        ("10.0.0.1", None, None, end + timedelta(microseconds=1)),
        ("10.0.0.1", None, None, T0 - timedelta(microseconds=1)),
        ("10.8.8.8", None, None, T0),
    )
    out = E.any_match(data, people, T0, end, as_of=end, strategy=strategy)
    got = {r._id: r.hr and r.hr.ip_address for r in out.collect()}
    assert got == {"0": "10.0.0.1", "1": "10.0.0.2", "2": None, "3": None, "4": None}
    hr = out.where("_id = '0'").first().hr
    assert hr.full_name == "F A" and len(hr) == 8


def test_any_match_default_window_and_whole_roster(spark):
    rows = [(f"10.1.{i // 250}.{i % 250}", "F", "L", "d", "s", "2020-01-01") for i in range(10_001)]
    hr = spark.createDataFrame(rows, HR)
    data = docs(spark, ("10.1.40.0", None, None, T0), ("10.1.0.0", None, None, T0 - timedelta(hours=25)))
    got = {r._id: r.hr is not None for r in E.any_match(data, hr, None, None, as_of=T0).collect()}
    assert got == {"0": True, "1": False}


def test_both_plans_give_repeated_and_missing_ids_the_same_person(spark, people):
    data = docs(spark, ("10.0.0.1", "10.0.0.2", None, T0), (None, None, "10.0.0.1", T0), (None, None, None, T0)).withColumn("_id", F.lit(None).cast("string"))
    data = data.unionByName(data.withColumn("_id", F.lit("same")))
    one, two = (sorted(map(str, E.ranked_lookup(data, people, strategy=s).collect())) for s in ("broadcast", "join"))
    assert one == two and len(one) == 6
    one, two = (sorted(map(str, E.any_match(data, people, None, None, as_of=T0, strategy=s).collect())) for s in ("broadcast", "join"))
    assert one == two and len(one) == 6


def test_merge_keeps_and_replace_drops_other_keys(spark, people):
    data = docs(spark, ("10.0.0.1", None, None), ("10.7.7.7", None, None)).withColumn(
        "enriched", F.struct(F.lit("x").alias("extra"), F.lit("old").alias("department"))
    )
    merged = {r._id: r.enriched for r in E.enrich_logs(data, people).collect()}
    replaced = {r._id: r.enriched for r in E.enrich_alerts(data, people).collect()}
    assert (merged["0"].extra, merged["0"].department) == ("x", "dept-A")
    assert (replaced["0"].extra, replaced["0"].department) == (None, "dept-A")
    for out in (merged, replaced):
        assert (out["1"].extra, out["1"].department, out["1"].last_name) == ("x", "old", None)


def test_update_by_id(spark, people):
    data = docs(spark, ("10.0.0.1", None, None), ("10.7.7.7", None, None))
    updates = E.ranked_lookup(data, people).where("match_rank is not null").select(
        "_index", "_id", E.enriched_struct(F.col("person"), null_as_empty=True).alias("update")
    )
    out = {r._id: r.enriched for r in E.update_by_id(data, updates, "enriched", "replace").collect()}
    assert out["0"].last_name == "A" and out["1"] is None


def test_select_docs_order_and_guard(spark):
    data = docs(spark, *[("10.0.0.1", None, None)] * 101)
    ids, alerts = E.id_frame(spark, " 3 , 4,"), data.where("_id in ('5', '6', '7')")
    assert sorted(r._id for r in E.select_docs(data, ids=ids, alerts=alerts).collect()) == ["3", "4"]
    assert E.select_docs(data, alerts=alerts).count() == 3
    assert E.select_docs(data, documents=data.where("_id <> '0'"), max_docs=100).count() == 100
    with pytest.raises(ValueError):
        E.select_docs(data, documents=data, max_docs=100)
    with pytest.raises(ValueError):
        E.select_docs(data)


def test_untouched(spark, people):
    data = docs(spark, ("10.0.0.1", None, None), ("10.7.7.7", None, None))
    assert [r._id for r in E.untouched_docs(data, people).collect()] == ["1"]


def test_fields_with_several_addresses(spark, people):
    schema = "_id string, _index string, client_ip array<string>, source_ip string, host_ip string, event_ts timestamp"
    rows = [("a", "ix", ["10.9.9.9", "10.9.9.8", "10.0.0.2"], "10.0.0.1", None, T0), ("b", "ix", None, "10.0.0.1", None, T0), ("c", "ix", [], None, None, T0)]
    data = spark.createDataFrame(rows, schema)
    out = {r._id: (r.match_rank, r.person and r.person.last_name) for r in E.ranked_lookup(data, people).collect()}
    assert out == {"a": (1, "AA"), "b": (2, "A"), "c": (None, None)}
    bulk = {r._id: r.hr and r.hr.ip_address for r in E.any_match(data, people, T0, T0, as_of=T0).collect()}
    assert bulk == {"a": "10.0.0.1", "b": "10.0.0.1", "c": None}


def test_an_address_of_half_the_documents_is_split(spark, people):
    n = F.col("id")
    address = F.when(n % 2 == 0, "10.0.0.1").when(n % 4 == 1, F.concat(F.lit("10.1.0."), (n % 250).cast("string")))
    none = F.lit(None).cast("string")
    data = spark.range(0, 4000, 1, 8).select(
        n.cast("string").alias("_id"), F.lit("ix").alias("_index"), address.alias("client_ip"), none.alias("source_ip"), none.alias("host_ip"), F.lit(T0).alias("event_ts")
    )
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for look in (lambda s: E.ranked_lookup(data, people, strategy=s).select("client_ip", "_id", F.col("person.last_name").alias("found")),
                     lambda s: E.any_match(data, people, T0, T0, as_of=T0, strategy=s).select("client_ip", "_id", F.col("hr.last_name").alias("found"))):
            want = sorted((r._id, r.found) for r in look("broadcast").collect())
            rows = look("join").withColumn("task", F.spark_partition_id()).collect()
            assert sorted((r._id, r.found) for r in rows) == want and len(want) == 4000
            assert all(len({r.task for r in rows if r.client_ip == hot}) > 1 for hot in ("10.0.0.1", None))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
