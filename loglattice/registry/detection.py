"""Joins between datasets, detections and streaming queries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from loglattice.operators import joins
from loglattice.plans import detect, documents, sketches
from loglattice.plans.messages import parse_messages
from loglattice.registry import derived, rendered
from loglattice.registry.correlation import _ENRICH_COLS, _HR_FLAT, _PEOPLE, _flat, _ranked_sql
from loglattice.registry.shared import ALERTS, AS_OF, HR, LINES, LOGS, TX, Query, load, sql_ts, text_ts, valid_ip
from loglattice.session import scratch_dir
from loglattice.sources import files
from loglattice.streaming import alerts as alert_stream
from loglattice.streaming import windows


def _events(spark, sf):
    """Typed events straight from the facts, one per event; some have no address."""
    (facts,) = load(spark, sf, "line_facts")
    return facts.select(
        "id", F.col("ms_ts").alias("ts"), F.when(F.col("id") % 17 != 0, F.col("ip")).alias("client_ip"), F.col("usr").alias("user_name"),
        (F.col("account") + F.col("n3")).alias("account_id"), F.col("status").alias("http_status"),
        F.col("path").alias("url_path"), F.col("size").alias("bytes"), F.col("lvl").alias("level"),
        F.col("event_type").alias("kind"), F.create_map(F.lit("rows"), F.col("ms").cast("string")).alias("kv"),
    )


_E = f"""(SELECT id, ms_ts AS ts, CASE WHEN id % 17 <> 0 THEN ip END AS client_ip, usr AS user_name, account + n3 AS account_id, status AS http_status,
  path AS url_path, size AS bytes, lvl AS level, event_type AS kind, ms AS export_rows FROM {LINES} AS f) AS e"""


def _parsed(spark, sf, kind):
    (facts,) = load(spark, sf, "line_facts")
    return parse_messages(rendered.messages(facts, kind, "id"), AS_OF)


def _days(df):
    return text_ts(df, "window_start", "window_end")


_A = f"(SELECT * FROM {_E} WHERE client_ip IS NOT NULL) AS a"
_DAY_COLS = (
    f"{sql_ts('date_trunc(' + chr(39) + 'day' + chr(39) + ', ts)')} AS window_start, "
    f"{sql_ts('date_trunc(' + chr(39) + 'day' + chr(39) + ', ts) + INTERVAL 1 DAY')} AS window_end"
)

# ---- joins -----------------------------------------------------------------------------------------------------

_INTERVALS = """SELECT * FROM (VALUES
  (1, TIMESTAMP '2024-01-05 10:00:00', TIMESTAMP '2024-01-05 22:30:00', 'recon'),
  (2, TIMESTAMP '2024-01-05 20:00:00', TIMESTAMP '2024-01-07 01:00:00', 'stuffing'),
  (3, TIMESTAMP '2024-01-20 00:00:00', TIMESTAMP '2024-01-21 00:00:00', 'exfil')) AS i(seq, start_ts, end_ts, phase)"""


def _interval_tags(max_listed):
    def run(spark, sf):
        (logs,) = load(spark, sf, "logs")
        tagged = joins.tag_intervals(
            logs, spark.sql(_INTERVALS), ["_index", "_id"], ts="event_ts", max_listed=max_listed
        )
        return tagged.select("_index", "_id", "phase", "in_any")

    return run


# An interval per event, in no order of time, and a third of them within one hour.
_MANY = """SELECT (id * 7919) % 1000003 AS seq, CASE id % 4 WHEN 0 THEN 'recon' WHEN 1 THEN 'stuffing' WHEN 2 THEN 'enumeration' ELSE 'exfil' END AS phase,
  CASE WHEN id % 3 = 0 THEN CAST('2024-01-15 10:00:00' AS TIMESTAMP) ELSE ms_ts END AS start_ts,
  CASE WHEN id % 3 = 0 THEN CAST('2024-01-15 11:00:00' AS TIMESTAMP) WHEN id % 101 = 0 THEN CAST('2024-01-01 00:00:00' AS TIMESTAMP) ELSE ms_ts + INTERVAL '1' HOUR END AS end_ts
FROM {line_facts} AS f WHERE id % 5 <> 0"""


def interval_tags_overlapping(spark, sf):
    facts, logs = load(spark, sf, "line_facts", "logs")
    tagged = joins.tag_intervals(logs, spark.sql(_MANY, line_facts=facts), ["_index", "_id"], ts="event_ts", max_listed=0)
    return tagged.select("_index", "_id", "phase", "in_any")


_MANY_SQL = f"""WITH iv AS ({_MANY.replace("{line_facts}", LINES)}), hit AS (
  SELECT event_ts, min_by(phase, seq) AS phase FROM (SELECT DISTINCT event_ts FROM {LOGS} AS l) AS t JOIN iv ON event_ts BETWEEN start_ts AND end_ts GROUP BY event_ts)
SELECT _index, _id, phase, phase IS NOT NULL AS in_any FROM {LOGS} AS l LEFT JOIN hit USING (event_ts)"""


_INTERVAL_SQL = f"""WITH iv AS ({_INTERVALS}), hit AS (
  SELECT _id, min(seq) AS seq FROM {LOGS} AS l JOIN iv ON l.event_ts BETWEEN iv.start_ts AND iv.end_ts GROUP BY _id)
SELECT l._index AS _index, l._id AS _id, iv.phase AS phase, iv.phase IS NOT NULL AS in_any
FROM {LOGS} AS l LEFT JOIN hit ON l._id = hit._id LEFT JOIN iv ON hit.seq = iv.seq"""


def log_person(spark, sf):
    facts, hr = load(spark, sf, "line_facts", "hr")
    events = parse_messages(rendered.messages(facts, "jsonish", "id"), AS_OF).select("id", "ts", "client_ip")
    return joins.events_to_persons(events, hr).drop("ts")


def log_account(spark, sf):
    facts, tx = load(spark, sf, "line_facts", "transactions")
    logs = facts.select(
        # The transactions are older than the events, so the events are moved back by 26 years.
        (F.col("ms_ts") - F.expr("interval 26 years")).alias("ts"), F.col("account").alias("account_id")
    )
    moves = tx.select(
        F.col("accountID").cast("bigint").alias("account_id"), F.col("timestamp").alias("ts"),
        F.col("event_amount").alias("amount"),
    )
    return joins.account_activity(logs, moves, days=20).withColumn("day", F.col("day").cast("string"))


def dim_enrich(spark, sf):
    (tx,) = load(spark, sf, "transactions")
    part, supplier, nation = (derived.table(spark, sf, t) for t in ("part", "supplier", "nation"))
    stores = part.select((F.col("p_partkey") % 13000 + 1).cast("int").alias("pos_id"), "p_brand", "p_type")
    banks = supplier.select((F.col("s_suppkey") % 30 + 1).cast("int").alias("bank_id"), "s_name")
    world = nation.select((F.col("n_nationkey") + 1).alias("world_id"), "n_name")
    out = joins.dim_enrich(
        tx.select("posID", "txbankId", "intbankID", "event_amount"),
        {"posID": (stores, "pos_id", ["p_brand", "p_type"]), "txbankId": (banks, "bank_id", ["s_name"]),
         "intbankID": (world, "world_id", ["n_name"])},
    )
    return out.groupBy("p_brand", "s_name", "n_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("event_amount").cast("decimal(18,2)")).cast("double").alias("amount")
    )


_BOUNDARY = datetime(2000, 7, 1, tzinfo=timezone.utc)


def archive_live(spark, sf):
    (tx,) = load(spark, sf, "transactions")
    both = joins.archive_and_live(tx, tx.drop("deposit_type"), _BOUNDARY)
    return both.groupBy("data_origin", F.year("timestamp").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count("deposit_type").alias("with_deposit_type")
    )


def roster_coverage(spark, sf):
    logs, hr = load(spark, sf, "logs", "hr")
    return joins.roster_coverage(logs, hr, "host_ip")


# ---- detections ------------------------------------------------------------------------------------------------


def top_talkers(spark, sf):
    out = detect.top_talkers(_events(spark, sf), 20)
    return out.withColumn("share", F.round("share", 9))


def status_burst(spark, sf):
    return _days(detect.status_burst(_events(spark, sf), 3, "1 day"))


def status_burst_sliding(spark, sf):
    return _days(detect.status_burst(_events(spark, sf), 4, "2 days", "1 day"))


def stuffing(spark, sf):
    events = _events(spark, sf).withColumn("user_name", F.concat("user_name", F.col("level")))
    return _days(detect.stuffing(events, 2, 2, "1 day", exact=True, failed=F.col("http_status") == 401))


def enumeration(spark, sf):
    return _days(detect.enumeration(_events(spark, sf), 3, "1 day", exact=True))


def probe_hits(spark, sf):
    return detect.probe_hits(_parsed(spark, sf, "nginx"))


def waf_hits(spark, sf):
    return detect.waf_hits(_parsed(spark, sf, "waf"))


def pool_saturation(spark, sf):
    out = detect.pool_saturation(_parsed(spark, sf, "hikari"), 3600, 0.96)
    return out.withColumn("max_used", F.round("max_used", 6))


def off_hours(spark, sf):
    out = detect.off_hours(_events(spark, sf), 1.2345)
    return out.select("client_ip", F.col("day").cast("string").alias("day"), "n", "off", F.round("z", 4).alias("z"))


def exfil(spark, sf):
    return _days(detect.exfil(_events(spark, sf), 90_000, "1 day", min_rows=900))


def travel(**options):
    def run(spark, sf):
        (facts,) = load(spark, sf, "line_facts")
        docs = documents.parsed(rendered.messages(facts, "audit_event", "id"), documents.AUDIT_DDL)
        flat = documents.flatten_audit(docs).select(F.col("source_ip").alias("client_ip"), "ts", "lat", "lon")
        out = text_ts(detect.impossible_travel(flat, 800.0, **options), "from_ts", "to_ts")
        return out.select("client_ip", "from_ts", "to_ts", F.round("km", 1).alias("km"), F.round("kmh", 1).alias("kmh"))

    return run


def rate_spikes(spark, sf):
    out = detect.rate_spikes(_events(spark, sf), ["kind"], 3600, 24, 2.0001)
    return out.select("kind", "bucket", "n", F.round("z", 4).alias("z"))


def change_points(bucket_seconds):
    def run(spark, sf):
        return detect.change_points(_events(spark, sf), ["kind", "level"], bucket_seconds, 5).withColumn("gap", F.round("gap", 6))

    return run


_EDGE = datetime(2001, 1, 1, tzinfo=timezone.utc)


def account_baseline(owner="accountID"):
    def run(spark, sf):
        (tx,) = load(spark, sf, "transactions")
        moves = tx.select(F.expr(owner).alias("account_id"), F.col("event_amount").alias("amount"), "timestamp")
        edge = F.lit(_EDGE).cast("timestamp")
        out = detect.account_baseline(moves.where(F.col("timestamp") < edge), moves.where(F.col("timestamp") >= edge))
        return out.withColumns({c: F.round(c, 3) for c in ("base_mean", "base_std", "recent_mean", "z")})

    return run


#: One account that holds a third of all transactions.
_BUSY = "CASE WHEN k % 3 = 0 THEN 1 ELSE accountID END"


def symbol_baseline(spark, sf):
    (tx,) = load(spark, sf, "transactions")
    out = detect.symbol_baseline(tx, 2.0001)
    return out.withColumns({"day": F.col("day").cast("string"), "z": F.round("z", 4)})


def ip_risk(spark, sf):
    facts, hr = load(spark, sf, "line_facts", "hr")
    events = parse_messages(rendered.messages(facts, "nginx"), AS_OF)
    out = detect.ip_risk_summary(events, hr)
    return out.withColumn("day", F.col("day").cast("string"))


def distinct_rollup(spark, sf):
    """Users and accounts per kind, day and week from stored hourly roll-ups, beside exact counts from the events."""
    events = _events(spark, sf)
    path = scratch_dir(spark, "hourly")
    files.write_partitions(sketches.hourly(events, ["kind"]).withColumn("day", F.to_date("hour")), path, ["day"])
    rollup = spark.read.parquet(path).drop("day")
    out = None
    for unit in ("day", "week"):
        found = sketches.united(rollup, ["kind"], F.date_trunc(unit, "hour"))
        counts = [F.count_distinct(c).alias(f"true_{n}") for n, c in (("users", "user_name"), ("accounts", "account_id"))]
        true = events.where("client_ip is not null").groupBy("kind", F.date_trunc(unit, "ts").alias("window")).agg(*counts)
        near = [(F.abs(F.col(c) - F.col(f"true_{c}")) <= F.ceil(sketches.ERROR * F.col(f"true_{c}"))).alias(f"{c}_within") for c in ("users", "accounts")]
        one = found.join(true, ["kind", "window"]).select(F.lit(unit).alias("unit"), "kind", "window", "events", "bytes", "true_users", "true_accounts", *near)
        out = one if out is None else out.unionByName(one)
    return text_ts(out, "window")


def enumeration_sketched(spark, sf):
    """Days of a kind of event with many accounts: sketches decide but near the threshold."""
    events = _events(spark, sf)
    rollup = sketches.hourly(events, ["kind"])
    found = sketches.at_least(rollup, events, "accounts", "account_id", _MANY_ACCOUNTS, F.date_trunc("day", "hour"), ["kind"])
    return text_ts(found, "window").select("kind", "window")


_MANY_ACCOUNTS = 60


# ---- streaming -------------------------------------------------------------------------------------------------


def _stream(spark, sf, name):
    """A derived input over the events table read as a stream."""
    schema = derived.table(spark, sf, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return spark.sql(derived.expanded(name), events=source)


def stream_alerts(spark, sf):
    (hr,) = load(spark, sf, "hr")
    folder = scratch_dir(spark, "alerts")
    query = alert_stream.enrich_stream(_stream(spark, sf, "alerts"), hr, f"{folder}/out", f"{folder}/checkpoint")
    query.awaitTermination()
    stored = alert_stream.read_enriched(spark, f"{folder}/out")
    return _flat(stored, "enriched", _HR_FLAT, "_index", "_id", "match_rank")


def _run_windows(spark, folder, counted):
    windows.store(counted, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(counted.schema).parquet(f"{folder}/out")


def windowed_counts(spark, sf):
    folder = scratch_dir(spark, "windows")
    source = _stream(spark, sf, "logs").withColumnRenamed("event_ts", "ts")
    count = lambda rows: windows.windowed_counts(rows, ["event_module"], "10 minutes", "6 hours", "3 hours")
    batch = load(spark, sf, "logs")[0].withColumnRenamed("event_ts", "ts")
    return _days(windows.with_open_windows(_run_windows(spark, folder, count(source)), count(batch)))


def session_counts(spark, sf):
    folder = scratch_dir(spark, "sessions")
    source = _stream(spark, sf, "logs").where("client_ip is not null").withColumnRenamed("event_ts", "ts")
    batch = load(spark, sf, "logs")[0].where("client_ip is not null").withColumnRenamed("event_ts", "ts")
    stored = _run_windows(spark, folder, windows.sessions(source, ["client_ip"], "3 hours", "10 minutes"))
    counted = windows.sessions(batch, ["client_ip"], "3 hours", None)
    return text_ts(windows.with_open_windows(stored, counted), "session_start", "session_end")


_OFF = "NOT (hour(ts) BETWEEN 13 AND 23)"
_HAV = """2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(lat - plat) / 2), 2)
    + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2))))"""
_BUCKET = "CAST(floor(epoch_us(ts) / {w}000000.0) AS BIGINT)"
_DEC = "CAST(event_amount AS DECIMAL(18,2))"

def _account_baseline_sql(owner: str = "accountID") -> str:
    return f"""WITH h AS (SELECT {owner} AS account_id, count(*) AS base_n, CAST(avg({_DEC}) AS DOUBLE) AS base_mean,
    stddev_samp(event_amount) AS base_std, quantile_disc(event_amount, 0.95) AS base_p95
  FROM {TX} AS t WHERE timestamp < TIMESTAMP '2001-01-01' GROUP BY 1), r AS (
  SELECT {owner} AS account_id, count(*) AS recent_n, CAST(avg({_DEC}) AS DOUBLE) AS recent_mean,
    max(event_amount) AS recent_max FROM {TX} AS t WHERE timestamp >= TIMESTAMP '2001-01-01' GROUP BY 1)
SELECT r.account_id AS account_id, recent_n, round(recent_mean, 3) AS recent_mean, recent_max, base_n,
  round(base_mean, 3) AS base_mean, round(base_std, 3) AS base_std, base_p95,
  round(CASE WHEN base_std > 0 THEN (recent_mean - base_mean) / base_std END, 3) AS z
FROM r LEFT JOIN h ON r.account_id = h.account_id"""


_TRAVEL_SQL = f"""WITH p AS (SELECT DISTINCT ip AS client_ip, ms_ts AS ts,
    CAST(CASE WHEN n3 = 0 THEN 39.7392 ELSE 46.7712 END AS DOUBLE) AS lat,
    CAST(CASE WHEN n3 = 0 THEN -104.9903 ELSE 23.6236 END AS DOUBLE) AS lon FROM {LINES} AS f),
  l AS (SELECT *, lag(ts) OVER w AS pts, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM p
    WINDOW w AS (PARTITION BY client_ip ORDER BY ts, lat, lon)),
  m AS (SELECT client_ip, pts, ts, {_HAV} AS km, (epoch_us(ts) - epoch_us(pts)) / 3600000000.0 AS h FROM l
    WHERE pts IS NOT NULL)
SELECT client_ip, {sql_ts("pts")} AS from_ts, {sql_ts("ts")} AS to_ts, round(km, 1) AS km,
  round(CASE WHEN h > 0 THEN km / h END, 1) AS kmh FROM m WHERE km >= 100 AND (h = 0 OR km > 800 * h)"""


def _change_points_sql(bucket_seconds: int) -> str:
    return f"""WITH c AS (SELECT kind, level, {_BUCKET.format(w=bucket_seconds)} AS bucket, count(*) AS n FROM {_E} GROUP BY ALL),
  b AS (SELECT kind, level, min(bucket) AS lo, max(bucket) AS hi FROM c GROUP BY ALL),
  f AS (SELECT kind, level, x.bucket AS bucket, coalesce(n, 0) AS n, lo, hi FROM (SELECT *, unnest(generate_series(lo, hi)) AS bucket FROM b) AS x
    LEFT JOIN c USING (kind, level, bucket)), w AS (
  SELECT *, sum(n) OVER a AS s, sum(n) OVER z AS e FROM f
  WINDOW a AS (PARTITION BY kind, level ORDER BY bucket ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
         z AS (PARTITION BY kind, level ORDER BY bucket ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
  r AS (SELECT *, row_number() OVER (PARTITION BY kind, level ORDER BY abs(e - s) DESC, bucket) AS rn FROM w
    WHERE bucket >= lo + 5 AND bucket <= hi - 4)
SELECT kind, level, bucket, round(abs(e - s) / 5, 6) AS gap FROM r WHERE rn = 1"""


QUERIES: dict[str, tuple[Query, str | None]] = {
    "interval_tags": (_interval_tags(10_000), _INTERVAL_SQL),
    "interval_tags_long_list": (_interval_tags(0), _INTERVAL_SQL),
    "interval_tags_overlapping": (interval_tags_overlapping, _MANY_SQL),
    "log_person": (
        log_person,
        f"""WITH {_PEOPLE} SELECT id, ip AS client_ip, {", ".join("p." + c + " AS " + c for c in _HR_FLAT)},
  CAST(date_diff('day', CAST(p.start_date AS DATE), CAST(ms_ts AS DATE)) AS INTEGER) AS tenure_days
FROM {LINES} AS f JOIN people AS p ON f.ip = p.hr_ip""",
    ),
    "log_account": (
        log_account,
        f"""WITH l AS (SELECT account AS account_id, CAST(ms_ts - INTERVAL 26 YEAR AS DATE) AS day, count(*) AS log_events
  FROM {LINES} AS f GROUP BY ALL), t AS (SELECT CAST(accountID AS BIGINT) AS account_id, CAST(timestamp AS DATE) AS day,
  count(*) AS n, sum({_DEC}) AS total FROM {TX} AS t GROUP BY ALL)
SELECT l.account_id AS account_id, CAST(l.day AS VARCHAR) AS day, log_events, CAST(coalesce(sum(n), 0) AS BIGINT) AS transactions,
  coalesce(CAST(sum(total) AS DOUBLE), 0) AS amount
FROM l LEFT JOIN t ON l.account_id = t.account_id AND t.day BETWEEN l.day - 20 AND l.day + 20
GROUP BY l.account_id, l.day, log_events""",
    ),
    "dim_enrich": (
        dim_enrich,
        f"""WITH s AS (SELECT k, b[1] AS p_brand FROM (SELECT CAST(p_partkey % 13000 + 1 AS INT) AS k,
    min([p_brand, p_type]) AS b FROM part GROUP BY 1) AS q), b AS (
  SELECT CAST(s_suppkey % 30 + 1 AS INT) AS k, min(s_name) AS s_name FROM supplier GROUP BY 1)
SELECT p_brand, s_name, n_name, count(*) AS n, CAST(sum({_DEC}) AS DOUBLE) AS amount
FROM {TX} AS t LEFT JOIN s ON t.posID = s.k LEFT JOIN b ON t.txbankId = b.k
  LEFT JOIN nation AS w ON t.intbankID = w.n_nationkey + 1 GROUP BY ALL""",
    ),
    "archive_live": (
        archive_live,
        f"""SELECT CASE WHEN timestamp < TIMESTAMP '2000-07-01' THEN 'historical_archive' ELSE 'live' END AS data_origin,
  CAST(year(timestamp) AS INTEGER) AS year, count(*) AS n,
  count(CASE WHEN timestamp < TIMESTAMP '2000-07-01' THEN deposit_type END) AS with_deposit_type
FROM {TX} AS t GROUP BY 1, 2""",
    ),
    "roster_coverage": (
        roster_coverage,
        f"""WITH a AS (SELECT DISTINCT host_ip AS ip FROM {LOGS} AS l WHERE host_ip IS NOT NULL),
  h AS (SELECT DISTINCT {valid_ip("ip_address")} AS ip FROM {HR} AS h)
SELECT ip, 'external' AS coverage FROM a WHERE ip NOT IN (SELECT ip FROM h WHERE ip IS NOT NULL)
UNION ALL SELECT ip, 'silent' FROM h WHERE ip IS NOT NULL AND ip NOT IN (SELECT ip FROM a)""",
    ),
    "top_talkers": (
        top_talkers,
        f"""SELECT client_ip, count(*) AS n, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM {_A}), 9) AS share
FROM {_A} GROUP BY client_ip ORDER BY n DESC, client_ip LIMIT 20""",
    ),
    "status_burst": (
        status_burst,
        f"""SELECT client_ip, count(*) AS n, {_DAY_COLS} FROM {_A} WHERE http_status IN (401, 403, 429)
GROUP BY client_ip, date_trunc('day', ts) HAVING count(*) >= 3""",
    ),
    "status_burst_sliding": (
        status_burst_sliding,
        f"""SELECT client_ip, count(*) AS n, {sql_ts("w")} AS window_start, {sql_ts("w + INTERVAL 2 DAY")} AS window_end
FROM (SELECT client_ip, date_trunc('day', ts) - to_days(CAST(unnest([0, 1]) AS INTEGER)) AS w FROM {_A}
  WHERE http_status IN (401, 403, 429)) AS x
GROUP BY client_ip, w HAVING count(*) >= 4""",
    ),
    "stuffing": (
        stuffing,
        f"""SELECT client_ip, count(*) AS failures, count(DISTINCT user_name || level) AS users, {_DAY_COLS} FROM {_A}
WHERE http_status = 401 GROUP BY client_ip, date_trunc('day', ts)
HAVING count(*) >= 2 AND count(DISTINCT user_name || level) >= 2""",
    ),
    "enumeration": (
        enumeration,
        f"""SELECT client_ip, count(DISTINCT account_id) AS accounts, {_DAY_COLS} FROM {_A}
GROUP BY client_ip, date_trunc('day', ts) HAVING count(DISTINCT account_id) >= 3""",
    ),
    "probe_hits": (
        probe_hits,
        f"""SELECT ip AS client_ip, 'path_traversal' AS rule, count(*) AS n FROM {LINES} AS f WHERE path LIKE '%etc/passwd%'
GROUP BY ip""",
    ),
    "waf_hits": (
        waf_hits,
        f"""SELECT ip AS client_ip, CAST(942100 + n3 AS VARCHAR) AS rule_id, count(*) AS n FROM {LINES} AS f GROUP BY 1, 2""",
    ),
    "pool_saturation": (
        pool_saturation,
        f"""SELECT host, bucket, round(max(used), 6) AS max_used, max(ms) AS max_waiting, count(*) AS n FROM (
  SELECT 'app-0' || n3 AS host, ms, CAST(floor(epoch_us(ms_ts) / 3600000000.0) AS BIGINT) AS bucket,
    CAST(38 + n12 AS DOUBLE) / 50 AS used FROM {LINES} AS f) AS p GROUP BY host, bucket HAVING max(used) >= 0.96""",
    ),
    "off_hours": (
        off_hours,
        f"""WITH d AS (SELECT client_ip, CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE {_OFF}) AS off
  FROM {_A} GROUP BY ALL), s AS (SELECT *, CAST(off AS DOUBLE) / n AS ratio FROM d), z AS (
  SELECT *, avg(ratio) OVER p AS m, stddev_samp(ratio) OVER p AS sd FROM s WINDOW p AS (PARTITION BY client_ip))
SELECT client_ip, CAST(day AS VARCHAR) AS day, n, off, round((ratio - m) / sd, 4) AS z FROM z
WHERE sd > 0 AND (ratio - m) / sd >= 1.2345""",
    ),
    "exfil": (
        exfil,
        f"""SELECT client_ip, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(export_rows) AS BIGINT) AS exported_rows,
  {_DAY_COLS} FROM {_A} GROUP BY client_ip, date_trunc('day', ts) HAVING sum(bytes) >= 90000 OR sum(export_rows) >= 900""",
    ),
    "travel": (travel(bucket_seconds=86_400), _TRAVEL_SQL),
    "travel_ten_minutes": (travel(), _TRAVEL_SQL),
    "rate_spikes": (
        rate_spikes,
        f"""WITH c AS (SELECT kind, {_BUCKET.format(w=3600)} AS bucket, count(*) AS n FROM {_E} GROUP BY ALL), w AS (
  SELECT *, coalesce(sum(n) OVER p, 0) AS t, coalesce(sum(n * n) OVER p, 0) AS q, least(24, bucket - min(bucket) OVER (PARTITION BY kind)) AS seen FROM c
  WINDOW p AS (PARTITION BY kind ORDER BY bucket RANGE BETWEEN 24 PRECEDING AND 1 PRECEDING)),
  z AS (SELECT *, t::DOUBLE / seen AS m, sqrt((q - t * (t::DOUBLE / seen)) / (seen - 1)) AS sd FROM w WHERE seen > 1)
SELECT kind, bucket, n, round((n - m) / sd, 4) AS z FROM z WHERE sd > 0 AND (n - m) / sd >= 2.0001""",
    ),
    "change_points": (change_points(86_400), _change_points_sql(86_400)),
    "change_points_sparse": (change_points(900), _change_points_sql(900)),
    "account_baseline": (account_baseline(), _account_baseline_sql()),
    "account_baseline_exact": (account_baseline(_BUSY), _account_baseline_sql(_BUSY)),
    "symbol_baseline": (
        symbol_baseline,
        f"""WITH d AS (SELECT security_symbol, CAST(timestamp AS DATE) AS day, sum(quantity) AS volume FROM {TX} AS t
  WHERE security_symbol IS NOT NULL AND quantity IS NOT NULL GROUP BY ALL), z AS (
  SELECT *, avg(volume) OVER p AS m, stddev_samp(volume) OVER p AS sd FROM d WINDOW p AS (PARTITION BY security_symbol))
SELECT security_symbol, CAST(day AS VARCHAR) AS day, volume, round((volume - m) / sd, 4) AS z FROM z
WHERE sd > 0 AND (volume - m) / sd >= 2.0001""",
    ),
    "ip_risk": (
        ip_risk,
        f"""WITH {_PEOPLE}, d AS (
  SELECT ip AS client_ip, CAST(sec_ts AS DATE) AS day, count(*) AS events,
    count(*) FILTER (WHERE status IN (401, 403, 429)) AS refused,
    count(*) FILTER (WHERE path LIKE '%etc/passwd%') AS probes,
    count(*) FILTER (WHERE NOT (hour(sec_ts) BETWEEN 13 AND 23)) AS off_hours, count(DISTINCT usr) AS users,
    count(DISTINCT account) AS accounts, CAST(sum(size) AS BIGINT) AS bytes FROM {LINES} AS f GROUP BY 1, 2)
SELECT client_ip, CAST(day AS VARCHAR) AS day, events, refused, probes, off_hours, users, accounts, bytes,
  {", ".join("p." + c + " AS " + c for c in _HR_FLAT)} FROM d LEFT JOIN people AS p ON d.client_ip = p.hr_ip""",
    ),
    "distinct_rollup": (
        distinct_rollup,
        "SELECT * FROM (" + " UNION ALL ".join(f"""SELECT '{u}' AS unit, kind, {sql_ts(f"date_trunc('{u}', ts)")} AS window, count(*) AS events,
  CAST(sum(bytes) AS BIGINT) AS bytes, count(DISTINCT user_name) AS true_users, count(DISTINCT account_id) AS true_accounts, TRUE AS users_within,
  TRUE AS accounts_within FROM {_A} GROUP BY kind, date_trunc('{u}', ts)""" for u in ("day", "week")) + ") AS x",
    ),
    "enumeration_sketched": (
        enumeration_sketched,
        f"""SELECT kind, {sql_ts("date_trunc('day', ts)")} AS window FROM {_A} GROUP BY kind, date_trunc('day', ts)
HAVING count(DISTINCT account_id) >= {_MANY_ACCOUNTS}""",
    ),
    "alert_stream": (stream_alerts, _ranked_sql(ALERTS, _ENRICH_COLS)),
    "windowed_counts": (
        windowed_counts,
        f"""WITH w AS (SELECT event_module, time_bucket(INTERVAL 3 HOUR, event_ts, TIMESTAMP '2024-01-01')
    - to_hours(CAST(unnest([0, 3]) AS INTEGER)) AS s FROM {LOGS} AS l)
SELECT event_module, {sql_ts("s")} AS window_start, {sql_ts("s + INTERVAL 6 HOUR")} AS window_end, count(*) AS n FROM w GROUP BY event_module, s""",
    ),
    "sessions": (
        session_counts,
        f"""WITH e AS (SELECT client_ip, event_ts AS ts, lag(event_ts) OVER (PARTITION BY client_ip ORDER BY event_ts) AS p
  FROM {LOGS} AS l WHERE client_ip IS NOT NULL), g AS (
  SELECT client_ip, ts, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 3 HOUR THEN 1 ELSE 0 END)
    OVER (PARTITION BY client_ip ORDER BY ts) AS s FROM e)
SELECT client_ip, {sql_ts("min(ts)")} AS session_start, {sql_ts("max(ts) + INTERVAL 3 HOUR")} AS session_end,
  count(*) AS n FROM g GROUP BY client_ip, s""",
    ),
}
