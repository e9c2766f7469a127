from datetime import datetime, timedelta, timezone

from loglattice.operators.enrich import enrich_alerts
from loglattice.streaming import alerts, windows

DOC = "_id string, _index string, client_ip string, source_ip string, host_ip string, event_ts timestamp"
HR = "ip_address string, first_name string, last_name string, department string, sub_department string, start_date string"
T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def drop(spark, folder, rows):
    spark.createDataFrame(rows, DOC).coalesce(1).write.mode("append").parquet(folder)


def run(spark, roster, folder):
    stream = spark.readStream.schema(DOC).parquet(f"{folder}/in")
    alerts.enrich_stream(stream, roster, f"{folder}/out", f"{folder}/ck").awaitTermination()
    return {r._id: r for r in alerts.read_enriched(spark, f"{folder}/out").collect()}


def test_redelivered_alerts_give_one_row_with_the_last_value(spark, tmp_path):
    roster = spark.createDataFrame([("10.0.0.1", "A", "One", "d1", "s", "x"), ("10.0.0.2", "B", "Two", "d2", "s", "x")], HR)
    folder = str(tmp_path)
    first = [("a", "ix", "10.0.0.1", None, None, T0), ("b", "ix", "10.0.0.9", None, None, T0)]
    first += [("a", "ix", "10.0.0.1", None, None, T0)] * 50
    drop(spark, f"{folder}/in", first)
    out = run(spark, roster, folder)
    assert len(out) == 2 and out["a"].enriched.last_name == "One" and out["b"].enriched is None
    # Restart with the same alert delivered again, and once more with a newer value.
    drop(spark, f"{folder}/in", [("a", "ix", "10.0.0.1", None, None, T0), ("a", "ix", "10.0.0.2", None, None, T0 + timedelta(1))])
    out = run(spark, roster, folder)
    assert len(out) == 2 and out["a"].enriched.last_name == "Two"
    assert run(spark, roster, folder)["a"].enriched.last_name == "Two"


def test_stream_equals_batch(spark, tmp_path):
    roster = spark.createDataFrame([(f"10.0.0.{i}", "F", f"L{i}", "d", "s", "x") for i in range(5)], HR)
    rows = [(str(i), "ix", f"10.0.0.{i % 9}", f"10.0.0.{i % 4}", None, T0) for i in range(40)]
    drop(spark, f"{tmp_path}/in", rows)
    streamed = run(spark, roster, str(tmp_path))
    batch = {r._id: r for r in enrich_alerts(spark.createDataFrame(rows, DOC), roster).collect()}
    assert {k: v.enriched for k, v in streamed.items()} == {k: v.enriched for k, v in batch.items()}


def collect_windows(spark, make, folder):
    source = spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    counted = make(source)
    windows.store(counted, f"{folder}/out", f"{folder}/ck").awaitTermination()
    return spark.read.schema(counted.schema).parquet(f"{folder}/out")


def test_late_rows_are_dropped_past_the_watermark(spark, tmp_path):
    folder = str(tmp_path)
    for minutes in ([0, 1, 30], [31], [2, 32], [90]):  # minute 2 arrives after the watermark has passed its window
        rows = [("a", T0 + timedelta(minutes=m)) for m in minutes]
        spark.createDataFrame(rows, "k string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    out = collect_windows(spark, lambda s: windows.windowed_counts(s, ["k"], "10 minutes", "5 minutes"), folder)
    got = {int((r.window_start.replace(tzinfo=timezone.utc) - T0).total_seconds() // 60): r.n for r in out.collect()}
    assert got == {0: 2, 30: 3}


def test_sessions_close_after_the_gap(spark, tmp_path):
    folder = str(tmp_path)
    rows = [("a", T0 + timedelta(minutes=m)) for m in (0, 10, 35, 100)] + [("b", T0 + timedelta(minutes=300))]
    spark.createDataFrame(rows, "k string, ts timestamp").coalesce(1).write.parquet(f"{folder}/in")
    out = collect_windows(spark, lambda s: windows.sessions(s, ["k"], "30 minutes"), folder)
    assert sorted(r.n for r in out.collect()) == [1, 3]
    batch = windows.sessions(spark.createDataFrame(rows, "k string, ts timestamp"), ["k"], "30 minutes", None)
    assert sorted(r.n for r in batch.collect()) == [1, 1, 3]
    whole = windows.with_open_windows(out, batch)
    assert sorted(map(str, whole.collect())) == sorted(map(str, batch.collect()))
