"""Streams that join, hold thresholds, and take alerts that fire again."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglattice.plans import detect
from loglattice.registry.correlation import _ENRICH_COLS, _HR_FLAT, _flat, _ranked_sql
from loglattice.registry.detection import _events, _run_windows, _stream
from loglattice.registry.shared import ALERTS, LINES, LOGS, Query, load, sql_ts, text_ts
from loglattice.session import scratch_dir
from loglattice.streaming import alerts as alert_stream
from loglattice.streaming import context, keyed, windows

#: Rounds in which alerts fire: all of them; some again with another address, some again unchanged; some again without an address.
_ROUNDS = (
    "SELECT * FROM {alerts}",
    "SELECT * EXCEPT (client_ip), CASE WHEN CAST(_id AS BIGINT) % 3 = 0 THEN host_ip ELSE client_ip END AS client_ip FROM {alerts} "
    "WHERE CAST(_id AS BIGINT) % 3 = 0 OR CAST(_id AS BIGINT) % 7 = 0",
    "SELECT * EXCEPT (client_ip), CAST(NULL AS STRING) AS client_ip FROM {alerts} WHERE CAST(_id AS BIGINT) % 5 = 0",
)
_LAST = f"""(SELECT * REPLACE (CASE WHEN CAST(_id AS BIGINT) % 5 = 0 THEN NULL WHEN CAST(_id AS BIGINT) % 3 = 0 THEN host_ip ELSE client_ip END AS client_ip)
FROM {ALERTS} AS a)"""


def alert_stream_refired(spark, sf):
    alerts, hr = load(spark, sf, "alerts", "hr")
    folder = scratch_dir(spark, "refired")
    for text in _ROUNDS:
        spark.sql(text, alerts=alerts).select(alerts.columns).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(alerts.schema).parquet(f"{folder}/in")
        # The events span a month, so nothing that fires again is late.
        alert_stream.enrich_refired(stream, hr, f"{folder}/out", f"{folder}/checkpoint", within="40 days").awaitTermination()
    enriched = alert_stream.enrich_alerts(alerts, hr)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in enriched.schema.fields)
    return _flat(keyed.read_store(spark, f"{folder}/out", schema), "enriched", _HR_FLAT, "_index", "_id", "match_rank")


_BEFORE, _AFTER = 6 * 3600, 3600


def _sides(logs):
    alerts = logs.where("event_module = 'ti_abusech'").select(F.col("_id").alias("alert_id"), "client_ip", F.col("event_ts").alias("alert_ts"))
    return alerts, logs.select(F.col("_id").alias("event_id"), "client_ip", "event_ts")


def stream_alert_context(spark, sf):
    folder = scratch_dir(spark, "context")
    alerts, _ = _sides(_stream(spark, sf, "logs"))
    _, events = _sides(_stream(spark, sf, "logs"))
    pairs = context.alert_context(alerts, events, _BEFORE, _AFTER)
    windows.store(pairs, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    counts = context.context_counts(spark.read.schema(pairs.schema).parquet(f"{folder}/out"))
    return text_ts(counts, "alert_ts", "first_ts", "last_ts")


def stream_status_burst(spark, sf):
    folder = scratch_dir(spark, "bursts")
    facts = _stream(spark, sf, "line_facts")
    events = facts.select(F.col("ms_ts").alias("ts"), F.when(F.col("id") % 17 != 0, F.col("ip")).alias("client_ip"), F.col("status").alias("http_status"))
    stored = _run_windows(spark, folder, context.status_bursts(events, 3, size="1 day"))
    batch = detect.status_burst(_events(spark, sf), 3, "1 day").select(*stored.columns)
    return text_ts(windows.with_open_windows(stored, batch), "window_start", "window_end")


_DAY = "date_trunc('day', ms_ts)"

QUERIES: dict[str, tuple[Query, str | None]] = {
    "alert_stream_refired": (alert_stream_refired, _ranked_sql(_LAST, _ENRICH_COLS)),
    "stream_alert_context": (
        stream_alert_context,
        f"""SELECT a._id AS alert_id, a.client_ip AS client_ip, {sql_ts("a.event_ts")} AS alert_ts, count(*) AS n,
  count(*) FILTER (WHERE e.event_ts < a.event_ts) AS n_before, {sql_ts("min(e.event_ts)")} AS first_ts, {sql_ts("max(e.event_ts)")} AS last_ts
FROM {LOGS} AS a JOIN {LOGS} AS e ON a.client_ip = e.client_ip AND e.event_ts BETWEEN a.event_ts - INTERVAL {_BEFORE} SECOND AND a.event_ts + INTERVAL {_AFTER} SECOND
WHERE a.event_module = 'ti_abusech' GROUP BY a._id, a.client_ip, a.event_ts""",
    ),
    "stream_status_burst": (
        stream_status_burst,
        f"""SELECT ip AS client_ip, {sql_ts(_DAY)} AS window_start, {sql_ts(_DAY + " + INTERVAL 1 DAY")} AS window_end, count(*) AS n
FROM {LINES} AS f WHERE id % 17 <> 0 AND status IN (401, 403, 429) GROUP BY ip, {_DAY} HAVING count(*) >= 3""",
    ),
}
