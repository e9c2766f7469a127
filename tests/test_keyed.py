"""The keyed store of alerts, and streams of events around alerts."""

from datetime import datetime, timedelta, timezone

import pytest

from conftest import plan_text
from loglattice.operators.enrich import enrich_alerts
from loglattice.plans import detect
from loglattice.streaming import alerts, context, keyed, windows

DOC = "_id string, _index string, v int, ts timestamp"
T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
KEY = ["_index", "_id"]


def put(spark, sink, batch_id, rows, buckets=4):
    keyed.merge_batch(spark.createDataFrame(rows, DOC), batch_id, sink, KEY, ["ts"], buckets)


def held(spark, sink):
    return sorted(map(tuple, keyed.read_store(spark, sink, DOC).select("_index", "_id", "v").collect()), key=str)


def doc(i, v, minutes=0, index="x"):
    return (i, index, v, T0 + timedelta(minutes=minutes))


def test_many_batches_leave_one_version(spark, tmp_path):
    sink, want = str(tmp_path), {}
    for n in range(9):
        rows = [doc(f"k{i}", 10 * n + i, n) for i in range(n, n + 6)]
        put(spark, sink, n, rows)
        want |= {r[0]: r[2] for r in rows}
        assert held(spark, sink) == sorted((("x", k, v) for k, v in want.items()), key=str)
    versions = [p for p in (tmp_path / "data").glob("slot=*/bucket=*") if any(p.glob("*.parquet"))]
    assert len(versions) <= 8
    stored = keyed.read_store(spark, sink, DOC)
    assert stored.count() == len(want) and "Exchange" not in plan_text(stored)
    opened = {p.rsplit("/", 1)[0] for p in stored.inputFiles()}
    assert len(opened) <= 8 and sum(p.stat().st_size > 0 for p in (tmp_path / "slots").rglob("*.parquet")) <= 2


def test_a_batch_that_runs_again_gives_the_same_table(spark, tmp_path):
    sink = str(tmp_path)
    put(spark, sink, 0, [doc("a", 1), doc("b", 1), (None, "x", 5, T0)])
    put(spark, sink, 1, [doc("a", 2), doc("c", 2), doc("a", 3, 5)])
    once = held(spark, sink)
    assert once == sorted([("x", "a", 3), ("x", "b", 1), ("x", "c", 2), ("x", None, 5)], key=str)
    for _ in range(3):
        put(spark, sink, 1, [doc("a", 2), doc("c", 2), doc("a", 3, 5)])
        assert held(spark, sink) == once
    put(spark, sink, 2, [(None, "x", 6, T0), doc("b", 9)])
    assert held(spark, sink) == sorted([("x", "a", 3), ("x", "b", 9), ("x", "c", 2), ("x", None, 6)], key=str)


def test_a_batch_lost_before_its_slots_are_named_is_not_seen(spark, tmp_path, monkeypatch):
    sink = str(tmp_path)
    put(spark, sink, 0, [doc("a", 1), doc("b", 1)])
    whole = keyed.files.write_partitions

    def fails(df, path, cols, **more):
        if path.endswith("slots"):
            raise OSError("lost")
        whole(df, path, cols, **more)

    monkeypatch.setattr(keyed.files, "write_partitions", fails)
    with pytest.raises(OSError):
        put(spark, sink, 1, [doc("a", 2)])
    assert held(spark, sink) == [("x", "a", 1), ("x", "b", 1)]
    monkeypatch.undo()
    put(spark, sink, 1, [doc("a", 2)])
    assert held(spark, sink) == [("x", "a", 2), ("x", "b", 1)]
    put(spark, sink, 2, [])
    assert held(spark, sink) == [("x", "a", 2), ("x", "b", 1)]


ALERT = "_id string, _index string, client_ip string, source_ip string, host_ip string, event_ts timestamp"
HR = "ip_address string, first_name string, last_name string, department string, sub_department string, start_date string"


def test_copies_are_dropped_in_the_stream_and_the_last_value_stays(spark, tmp_path):
    roster = spark.createDataFrame([(f"10.0.0.{i}", "F", f"L{i}", "d", "s", "x") for i in range(5)], HR)
    rounds = [[(str(i), "ix", f"10.0.0.{i % 7}", None, None, T0) for i in range(20)] * 3, [(str(i), "ix", "10.0.0.2", None, None, T0) for i in range(0, 20, 3)], [("1", "ix", "10.0.0.1", None, None, T0)]]
    last = {}
    for rows in rounds:
        spark.createDataFrame(rows, ALERT).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(ALERT).parquet(f"{tmp_path}/in")
        query = alerts.enrich_refired(stream, roster, f"{tmp_path}/out", f"{tmp_path}/ck", buckets=3, within="1 hour")
        query.awaitTermination()
        last |= {r[0]: r for r in rows}
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == len({r for rows in rounds for r in rows})  # one row per alert and content, not per arrival
    batch = enrich_alerts(spark.createDataFrame(list(last.values()), ALERT), roster)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields)
    got = keyed.read_store(spark, f"{tmp_path}/out", schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))


def _event(i, ip, minutes):
    return (i, ip, T0 + timedelta(minutes=minutes))


def test_context_over_many_batches_equals_the_batch_join(spark, tmp_path):
    fired = [_event(f"a{i}", "10.0.0.1" if i % 3 else "10.0.0.2", 37 * i) for i in range(40)] + [_event("none", None, 5), _event("far", "10.9.9.9", 5)]
    seen = [_event(f"e{i}", "10.0.0.1" if i % 4 else "10.0.0.2", 5 * i) for i in range(300)]
    schemas = "alert_id string, client_ip string, alert_ts timestamp", "event_id string, client_ip string, event_ts timestamp"
    for n in range(0, 300, 60):  # in order of time, an hour or more apart from batch to batch
        lo, hi = T0 + timedelta(minutes=5 * n), T0 + timedelta(minutes=5 * (n + 60))
        for name, rows, schema in (("alerts", fired, schemas[0]), ("events", seen, schemas[1])):
            part = [r for r in rows if lo <= r[2] < hi]
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        sides = [spark.readStream.schema(s).parquet(f"{tmp_path}/{name}") for name, s in zip(("alerts", "events"), schemas, strict=True)]
        pairs = context.alert_context(*sides, 3600, 600)
        windows.store(pairs, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    got = spark.read.schema(pairs.schema).parquet(f"{tmp_path}/out")
    batch = context.alert_context(spark.createDataFrame(fired, schemas[0]), spark.createDataFrame(seen, schemas[1]), 3600, 600)
    want = {(a, e) for a, ip, t in fired for e, other, u in seen if ip == other and -3600 <= (u - t).total_seconds() <= 600}
    assert {(r["alert_id"], r["event_id"]) for r in batch.collect()} == want and batch.count() == len(want)
    assert {(r["alert_id"], r["event_id"]) for r in got.collect()} == want and got.count() == len(want)
    counts = {r["alert_id"]: r["n"] for r in context.context_counts(got).collect()}
    assert sum(counts.values()) == len(want) and "far" not in counts


def test_bursts_on_a_stream_equal_the_batch(spark, tmp_path):
    rows = [(T0 + timedelta(seconds=20 * i), None if i % 11 == 0 else f"10.0.0.{i % 3}", (401, 200, 403, 429)[i % 4]) for i in range(400)]
    spark.createDataFrame(rows, "ts timestamp, client_ip string, http_status int").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, client_ip string, http_status int").parquet(f"{tmp_path}/in")
    found = context.status_bursts(stream, 4)
    windows.store(found, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    stored = spark.read.schema(found.schema).parquet(f"{tmp_path}/out")
    batch = detect.status_burst(spark.read.parquet(f"{tmp_path}/in"), 4).select(*stored.columns)
    whole = windows.with_open_windows(stored, batch)
    assert 0 < stored.count() and sorted(map(str, whole.collect())) == sorted(map(str, batch.collect()))
