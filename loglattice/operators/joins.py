"""Look-ups and correlations between events, roster, transactions and reference tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglattice.functions.ip import to_ip
from loglattice.operators.asof import disjoint_segments, last_before
from loglattice.operators.enrich import HR_FIELDS, one_person_per_ip
from loglattice.operators.lookup import lookup_join
from loglattice.session import fits_broadcast, stored

#: More intervals than this are cut into segments instead of being looked up in broadcast lists.
MAX_LISTED_INTERVALS = 10_000


def tag_intervals(
    events: DataFrame,
    intervals: DataFrame,
    key: Sequence[str],
    ts: str = "ts",
    bucket_seconds: int = 3600,
    max_listed: int = MAX_LISTED_INTERVALS,
) -> DataFrame:
    """All events plus ``phase`` of the first listed interval (lowest ``seq``) that holds the time, and ``in_any``.

    ``intervals`` has ``seq, start_ts, end_ts, phase``; both bounds are inclusive. A short table becomes one list per
    time bucket, looked up without a shuffle of the events. A long one is cut into disjoint segments that each have one winner, and every
    distinct time takes the last segment before it. The tag follows from the time alone, so event keys play no part.
    """
    if intervals.count() <= max_listed:

        def bucket(column: Column) -> Column:
            return F.floor(column.cast("timestamp").cast("double") / bucket_seconds).cast("bigint")

        pieces = intervals.select(
            F.explode(F.sequence(bucket(F.col("start_ts")), bucket(F.col("end_ts")))).alias("__bucket"),
            F.struct("seq", "start_ts", "end_ts", "phase").alias("i"),
        )
        placed = events.withColumn("__bucket", bucket(F.col(ts)))
        lists = pieces.groupBy("__bucket").agg(F.array_sort(F.collect_list("i")).alias("__list"))
        hit = F.filter("__list", lambda i: F.col(ts).between(i["start_ts"], i["end_ts"]))
        found = lookup_join(placed, lists, ["__bucket"]).withColumn("__hit", F.get(hit, F.lit(0)))
        return found.select(
            *events.columns, F.col("__hit.phase").alias("phase"), F.col("__hit").isNotNull().alias("in_any")
        )
    timed = events.withColumn("__t", F.unix_micros(F.col(ts).cast("timestamp")))
    times = timed.select(F.col("__t").alias("t")).where("t is not null").distinct()
    best = last_before(times, disjoint_segments(intervals)).where("hit is not null").select(F.col("t").alias("__t"), F.col("hit").alias("__hit"))
    return lookup_join(timed, stored(best, "tagged-times"), ["__t"]).select(
        *events.columns, F.col("__hit.phase").alias("phase"), F.col("__hit").isNotNull().alias("in_any")
    )


def events_to_persons(events: DataFrame, roster: DataFrame, ip: str = "client_ip", ts: str = "ts") -> DataFrame:
    """Events of employees with their roster row and tenure in days at the time of the event."""
    people = one_person_per_ip(roster)
    joined = lookup_join(events.withColumn("hr_ip", to_ip(ip)), people, ["hr_ip"], "inner")
    hired = F.try_to_date("start_date", "yyyy-MM-dd")
    return joined.select(*events.columns, *[F.col(f"person.{c}").alias(c) for c in HR_FIELDS]).withColumn(
        "tenure_days", F.datediff(F.col(ts), hired)
    )


def account_activity(logs: DataFrame, tx: DataFrame, days: int = 1) -> DataFrame:
    """Per account and day with log events: events, and transactions within ``days`` before or after.

    Both sides are reduced to one row per account and day before they meet in one window over the account's days, so a busy account never
    multiplies and no row is repeated for the days that it is near to. Transactions of accounts without log events are left out first, by a
    semi join if the accounts fit a broadcast, else after the reduction.
    """
    seen = logs.where(F.col("account_id").isNotNull()).select("account_id", F.to_date("ts").alias("day"))
    log_days = seen.groupBy("account_id", "day").agg(F.count(F.lit(1)).alias("log_events"))
    accounts = seen.select("account_id").distinct()
    small = fits_broadcast(accounts)
    moves = tx.join(F.broadcast(accounts), "account_id", "left_semi") if small else tx
    tx_days = moves.groupBy("account_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("total")
    )
    tx_days = tx_days if small else tx_days.join(accounts, "account_id", "left_semi")
    both = log_days.unionByName(tx_days, allowMissingColumns=True).withColumn("day_no", F.unix_date("day"))
    near = Window.partitionBy("account_id").orderBy("day_no").rangeBetween(-days, days)
    sums = both.select(
        "account_id", "day", "log_events", F.coalesce(F.sum("n").over(near), F.lit(0)).alias("transactions"),
        F.coalesce(F.sum("total").over(near).cast("double"), F.lit(0.0)).alias("amount"),
    )
    return sums.where("log_events is not null")


def dim_enrich(facts: DataFrame, dims: Mapping[str, tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Left look-ups into dimension tables: foreign key to (table, key, columns). Repeated keys never multiply facts."""
    out = facts
    for foreign, (table, key, columns) in dims.items():
        one = table.groupBy(F.col(key).alias(foreign)).agg(F.min(F.struct(*columns)).alias("__dim"))
        out = lookup_join(out, one.select(foreign, *[F.col(f"__dim.{c}").alias(c) for c in columns]), [foreign])
    return out


def archive_and_live(archive: DataFrame, live: DataFrame, boundary: datetime, ts: str = "timestamp") -> DataFrame:
    """One history: the archive before ``boundary``, the live data from it on, tagged by ``data_origin``."""
    edge = F.lit(boundary).cast("timestamp")
    old = archive.where(F.col(ts) < edge).withColumn("data_origin", F.lit("historical_archive"))
    new = live.where(F.col(ts) >= edge).withColumn("data_origin", F.lit("live"))
    return old.unionByName(new, allowMissingColumns=True)


def roster_coverage(logs: DataFrame, roster: DataFrame, ip: str = "client_ip") -> DataFrame:
    """Addresses seen only in logs (``external``) and employees without any log (``silent``)."""
    seen = logs.select(to_ip(ip).alias("ip")).where(F.col("ip").isNotNull()).distinct()
    held = roster.select(to_ip("ip_address").alias("ip")).where(F.col("ip").isNotNull()).distinct()
    return (
        seen.join(held, "ip", "left_anti").withColumn("coverage", F.lit("external"))
        .unionByName(held.join(seen, "ip", "left_anti").withColumn("coverage", F.lit("silent")))
    )
