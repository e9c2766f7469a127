"""Detections over parsed events.

Input columns follow ``parse_messages``: ``ts, client_ip, user_name, account_id, http_status, url_path, bytes, kind, kv``.
Every job reduces events to counts per key and time bucket before any window runs, so the size of a window partition
is set by the number of buckets and not by how busy a key is.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglattice.functions.scalars import business_hour
from loglattice.operators.enrich import HR_FIELDS, one_person_per_ip
from loglattice.operators.lookup import lookup_join
from loglattice.operators.quantiles import exact_percentile

# Request and agent patterns per probe rule.
PROBES = {
    "path_traversal": r"(?i)\.\./|%2f\.\.|etc/passwd",
    "sql_injection": r"(?i)union\s+select|' or '|'\s*--|drop table|sleep\(|%27%20or",
    "hidden_file": r"/\.(env|git)\b",
    "admin_surface": r"(?i)wp-login|phpmyadmin|/actuator/(env|heapdump)|/admin\b",
    "scanner_agent": r"(?i)sqlmap|nmap|hydra|python-requests|go-http-client",
}


def _addressed(events: DataFrame) -> DataFrame:
    """Events with an address; those without one are nobody's."""
    return events.where(F.col("client_ip").isNotNull())


def auth_failed() -> Column:
    """Whether an event reports a refused log-in: by status, by reason or outcome, or in the words of its body."""
    kv, words = F.col("kv"), r"(?i)failed (login|password)|authentication (failed|failure)|excessive authentication failures"
    said = [F.lower(kv["reason"]) == "bad_credentials", (F.col("kind") == "cef") & (F.lower(kv["outcome"]) == "failure"), kv["body"].rlike(words), kv["name"].rlike(words)]
    out = F.coalesce(F.col("http_status") == 401, F.lit(False))
    for one in said:
        out = out | F.coalesce(one, F.lit(False))
    return out


def _distinct(column: str, exact: bool) -> Column:
    return F.count_distinct(column) if exact else F.approx_count_distinct(column)


def _windowed(df: DataFrame, keys: Sequence[str], size: str, slide: str | None, *aggs: Column) -> DataFrame:
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    out = df.groupBy(*keys, window.alias("w")).agg(*aggs)
    return out.withColumns({"window_start": F.col("w.start"), "window_end": F.col("w.end")}).drop("w")


def top_talkers(events: DataFrame, k: int) -> DataFrame:
    """The ``k`` busiest addresses with their share of all events."""
    from loglattice.operators.shares import share_of_total

    counts = share_of_total(_addressed(events), "client_ip")
    return counts.orderBy(F.desc("n"), "client_ip").limit(k)


def status_burst(
    events: DataFrame, threshold: int, size: str = "5 minutes", slide: str | None = None,
    statuses: Sequence[int] = (401, 403, 429),
) -> DataFrame:
    """Windows in which an address collects at least ``threshold`` refused requests."""
    refused = _addressed(events).where(F.col("http_status").isin(*statuses))
    out = _windowed(refused, ["client_ip"], size, slide, F.count(F.lit(1)).alias("n"))
    return out.where(F.col("n") >= threshold)


def stuffing(
    events: DataFrame, min_failures: int, min_users: int, size: str = "1 hour", exact: bool = False, failed: Column | None = None
) -> DataFrame:
    """Addresses failing to log in as many different users.

    ``failed`` is by default any refused log-in of ``auth_failed``, or the status alone where events have no pairs.
    """
    if failed is None:
        failed = auth_failed() if "kv" in events.columns else F.col("http_status") == 401
    failed = _addressed(events).where(failed)
    out = _windowed(
        failed, ["client_ip"], size, None, F.count(F.lit(1)).alias("failures"),
        _distinct("user_name", exact).alias("users"),
    )
    return out.where((F.col("failures") >= min_failures) & (F.col("users") >= min_users))


def enumeration(events: DataFrame, min_accounts: int, size: str = "1 hour", exact: bool = False) -> DataFrame:
    """Addresses touching many different accounts."""
    touched = _addressed(events).where(F.col("account_id").isNotNull())
    out = _windowed(touched, ["client_ip"], size, None, _distinct("account_id", exact).alias("accounts"))
    return out.where(F.col("accounts") >= min_accounts)


def probe_tags(url: Column, agent: Column, *more: Column) -> Column:
    """Names of the probe rules a request matches; ``more`` are further texts, such as a firewall's payload."""
    text = F.concat_ws(" ", url, agent, *more)
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(n)) for n, p in PROBES.items()]))


def event_probe_tags() -> Column:
    """The probe rules that a parsed event matches in its url, agent or firewall payload."""
    kv = F.col("kv")
    return probe_tags(F.col("url_path"), kv["agent"], kv["user_agent"], kv["data"])


def probe_hits(events: DataFrame) -> DataFrame:
    """Matches per address and probe rule, in urls, agents and firewall payloads."""
    tags = event_probe_tags()
    return (
        _addressed(events).select("client_ip", F.explode(tags).alias("rule"))
        .groupBy("client_ip", "rule")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def waf_hits(events: DataFrame) -> DataFrame:
    """Firewall blocks per address and rule."""
    blocked = _addressed(events).where(F.col("kind") == "waf")
    return blocked.groupBy("client_ip", F.col("kv")["rule_id"].alias("rule_id")).agg(F.count(F.lit(1)).alias("n"))


def off_hours(events: DataFrame, z: float) -> DataFrame:
    """Days on which the off-hours share of an address departs from its own history."""
    days = _addressed(events).groupBy("client_ip", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~business_hour("ts")).alias("off")
    ).withColumn("ratio", F.col("off") / F.col("n"))
    history = Window.partitionBy("client_ip")
    mean, spread = F.avg("ratio").over(history), F.stddev_samp("ratio").over(history)
    scored = days.withColumn("z", F.when(spread > 0, (F.col("ratio") - mean) / spread))
    return scored.where(F.col("z") >= z)


def exfil(events: DataFrame, min_bytes: int, size: str = "1 day", min_rows: int | None = None) -> DataFrame:
    """Addresses that move many bytes, or export many rows, within a window."""
    rows = F.col("kv")["rows"].try_cast("bigint")
    out = _windowed(
        _addressed(events), ["client_ip"], size, None, F.sum("bytes").alias("bytes"), F.sum(rows).alias("exported_rows")
    )
    many = F.lit(False) if min_rows is None else F.coalesce(F.col("exported_rows") >= min_rows, F.lit(False))
    return out.where(F.coalesce(F.col("bytes") >= min_bytes, F.lit(False)) | many)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), 2
    )
    return F.lit(2 * 6371.0) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def impossible_travel(events: DataFrame, max_kmh: float, min_km: float = 100.0, bucket_seconds: int = 600) -> DataFrame:
    """Consecutive positions of one address that are too far apart for the time between them.

    ``events`` has ``client_ip, ts, lat, lon``. Equal positions at one instant collapse first. Neighbours inside a time
    bucket come from a window over that bucket; neighbours across buckets come from the first and last position of each
    bucket. No window ever holds all rows of a busy address.
    """
    point = F.struct("ts", "lat", "lon")
    points = (
        events.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .select("client_ip", "ts", "lat", "lon")
        .distinct()
        .withColumn("bucket", F.floor(F.unix_micros("ts") / (bucket_seconds * 1_000_000)))
    )
    inside = points.select(
        "client_ip",
        F.lag(point).over(Window.partitionBy("client_ip", "bucket").orderBy("ts", "lat", "lon")).alias("a"),
        point.alias("b"),
    )
    edges = points.groupBy("client_ip", "bucket").agg(F.min(point).alias("b"), F.max(point).alias("last"))
    across = edges.select(
        "client_ip", F.lag("last").over(Window.partitionBy("client_ip").orderBy("bucket")).alias("a"), "b"
    )
    pairs = inside.unionByName(across).where(F.col("a").isNotNull())
    hours = (F.unix_micros("b.ts") - F.unix_micros("a.ts")) / 3_600_000_000
    km = haversine_km(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon"))
    moved = pairs.select(
        "client_ip", F.col("a.ts").alias("from_ts"), F.col("b.ts").alias("to_ts"), km.alias("km"), hours.alias("hours")
    )
    too_fast = (F.col("hours") == 0) | (F.col("km") > F.lit(max_kmh) * F.col("hours"))
    return moved.where((F.col("km") >= min_km) & too_fast).withColumn(
        "kmh", F.when(F.col("hours") > 0, F.col("km") / F.col("hours"))
    )


def rate_series(events: DataFrame, keys: Sequence[str], bucket_seconds: int) -> DataFrame:
    """Events per key and time bucket."""
    bucket = F.floor(F.unix_micros("ts") / (bucket_seconds * 1_000_000)).cast("bigint")
    return events.groupBy(*keys, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def rate_spikes(events: DataFrame, keys: Sequence[str], bucket_seconds: int, lookback: int, z: float) -> DataFrame:
    """Buckets whose rate lies ``z`` deviations above the ``lookback`` buckets before; a bucket without events counts as zero.

    The history of a series begins with its first event.
    """
    series = rate_series(events, keys, bucket_seconds)
    order = Window.partitionBy(*keys).orderBy("bucket")
    before = order.rangeBetween(-lookback, -1)
    first = F.min("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    scored = series.withColumns({
        "total": F.coalesce(F.sum("n").over(before), F.lit(0)), "squares": F.coalesce(F.sum(F.col("n") * F.col("n")).over(before), F.lit(0)),
        "seen": F.least(F.lit(lookback), F.col("bucket") - first),
    })
    mean = F.col("total") / F.col("seen")
    spread = F.sqrt((F.col("squares") - F.col("total") * mean) / (F.col("seen") - 1))
    scored = scored.where(F.col("seen") > 1).withColumns({"mean": mean, "spread": spread})
    scored = scored.withColumn("z", F.when(F.col("spread") > 0, (F.col("n") - F.col("mean")) / F.col("spread")))
    return scored.where(F.col("z") >= z).drop("total", "squares", "seen")


def pool_saturation(events: DataFrame, bucket_seconds: int, min_active: float = 0.9) -> DataFrame:
    """Time buckets in which connection pools ran nearly full."""
    pool = events.where(F.col("kind") == "hikari").select(
        "ts",
        F.col("kv")["host"].alias("host"),
        (F.col("kv")["active"].try_cast("double") / F.col("kv")["total"].try_cast("double")).alias("used"),
        F.col("kv")["waiting"].try_cast("bigint").alias("waiting"),
    )
    bucket = F.floor(F.unix_micros("ts") / (bucket_seconds * 1_000_000)).cast("bigint")
    out = pool.groupBy("host", bucket.alias("bucket")).agg(
        F.max("used").alias("max_used"), F.max("waiting").alias("max_waiting"), F.count(F.lit(1)).alias("n")
    )
    return out.where(F.col("max_used") >= min_active)


def change_points(events: DataFrame, keys: Sequence[str], bucket_seconds: int, width: int) -> DataFrame:
    """Per series the earliest bucket where the mean rate of ``width`` buckets before and from it on differs most; a silent bucket counts as zero.

    Both windows must lie within the series. The gap changes only where an event bucket enters or leaves a window: behind it, ``width`` behind that,
    and where the later window first reaches it. These buckets and the first one with whole windows are all that can be the earliest of a maximum.
    """
    series = rate_series(events, keys, bucket_seconds)
    bounds = Window.partitionBy(*keys)
    series = series.withColumns({"start": F.min("bucket").over(bounds), "end": F.max("bucket").over(bounds)})
    own, zero = F.struct("bucket", "n"), F.lit(0).cast("bigint").alias("n")
    changes = [F.struct(b.alias("bucket"), zero) for b in (F.col("bucket") + 1, F.col("bucket") + width + 1, F.col("bucket") - width + 1, F.col("start") + width)]
    rows = series.select(*keys, "start", "end", F.explode(F.array(own, *changes)).alias("row")).where(F.col("row.bucket").between(F.col("start"), F.col("end")))
    series = rows.groupBy(*keys, "start", "end", F.col("row.bucket").alias("bucket")).agg(F.sum("row.n").alias("n"))
    order = Window.partitionBy(*keys).orderBy("bucket")
    sums = {
        "before": F.coalesce(F.sum("n").over(order.rangeBetween(-width, -1)), F.lit(0)),
        "after": F.coalesce(F.sum("n").over(order.rangeBetween(0, width - 1)), F.lit(0)),
    }
    whole = (F.col("bucket") - F.col("start") >= width) & (F.col("end") - F.col("bucket") >= width - 1)
    gaps = series.withColumns(sums).where(whole)
    gap = F.abs(F.col("after") - F.col("before"))
    best = gaps.groupBy(*keys).agg(F.max(F.struct(gap.alias("gap"), (-F.col("bucket")).alias("at"))).alias("best"))
    return best.select(*keys, (-F.col("best.at")).alias("bucket"), (F.col("best.gap") / width).alias("gap"))


def account_baseline(history: DataFrame, recent: DataFrame, z: float | None = None) -> DataFrame:
    """Recent activity per account against its own archive.

    Both inputs have ``account_id, amount``. The archive percentile is exact, and no account's amounts are gathered in one place.
    """
    amount = F.col("amount").cast("decimal(18,2)")
    base = history.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("base_n"),
        F.avg(amount).cast("double").alias("base_mean"),
        F.stddev_samp("amount").alias("base_std"),
    )
    base = base.join(exact_percentile(history, ["account_id"], "amount", 0.95, "base_p95"), "account_id", "left")
    now = recent.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("recent_n"), F.avg(amount).cast("double").alias("recent_mean"),
        F.max("amount").alias("recent_max"),
    )
    out = now.join(base, "account_id", "left").withColumn(
        "z", F.when(F.col("base_std") > 0, (F.col("recent_mean") - F.col("base_mean")) / F.col("base_std"))
    )
    return out if z is None else out.where(F.col("z") >= z)


def symbol_baseline(tx: DataFrame, z: float) -> DataFrame:
    """Days on which a symbol's traded volume departs from its own history."""
    days = tx.where(F.col("security_symbol").isNotNull() & F.col("quantity").isNotNull()).groupBy(
        "security_symbol", F.to_date("timestamp").alias("day")
    ).agg(F.sum("quantity").alias("volume"))
    history = days.groupBy(F.col("security_symbol").alias("symbol")).agg(
        F.avg("volume").alias("mean"), F.stddev_samp("volume").alias("spread")
    )
    scored = days.join(history, F.col("security_symbol") == F.col("symbol")).withColumn(
        "z", F.when(F.col("spread") > 0, (F.col("volume") - F.col("mean")) / F.col("spread"))
    )
    return scored.where(F.col("z") >= z).select("security_symbol", "day", "volume", "z")


def ip_risk_summary(events: DataFrame, roster: DataFrame) -> DataFrame:
    """Per address and day: volume, refusals, probes, users, accounts and bytes, with the person behind it.

    Days are united from hourly roll-ups; users and accounts are distinct counts by sketch, exact for small sets.
    """
    from loglattice.plans import sketches

    daily = sketches.daily(sketches.hourly(events))
    people = one_person_per_ip(roster)
    joined = lookup_join(daily.withColumn("hr_ip", F.col("client_ip")), people, ["hr_ip"])
    return joined.select(*daily.columns, *[F.col(f"person.{c}").alias(c) for c in HR_FIELDS])
