"""Attack campaigns: events as evidence of a phase, and addresses that went through the phases in order.

Events follow ``parse_messages``. Evidence is reduced to hits per address, time bucket and phase first; one window per phase over these rows
then carries the latest start of a chain forward, so a busy address costs as many rows as it has active buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglattice.plans.detect import _addressed, auth_failed, event_probe_tags

#: The phases of an attack in their order.
PHASES = ("recon", "stuffing", "enumeration", "exfil")
_LOGIN, _EXPORT, _DENIED = r"(?i)/(auth|login|signin|session)\b", r"(?i)bulk export requested", r"(?i)unauthorized account access"


def attack_phase(min_bytes: int = 1_000_000, min_rows: int = 5_000) -> Column:
    """The phase an event is evidence of, or null; the later phase where several would fit.

    Many bytes or an export of many rows are exfiltration. A refused log-in is stuffing, a mere status 401 only on a log-in url. A firewall block
    is reconnaissance. An account touched without success or right is enumeration. Probe paths, payloads and scanner agents are reconnaissance.
    """
    kv, status, body = F.col("kv"), F.col("http_status"), F.col("kv")["body"]
    exported = body.rlike(_EXPORT) & (kv["rows"].try_cast("bigint") >= min_rows)
    moved = F.col("bytes") >= min_bytes
    login = auth_failed() & (F.coalesce(status != 401, F.lit(True)) | F.col("url_path").rlike(_LOGIN))
    refused = F.col("account_id").isNotNull() & (status.isin(403, 404) | body.rlike(_DENIED))
    found = F
    for rule, phase in ((moved, "exfil"), (exported, "exfil"), (login, "stuffing"), (F.col("kind") == "waf", "recon"), (refused, "enumeration"),
                        (F.size(event_probe_tags()) > 0, "recon")):
        found = found.when(F.coalesce(rule, F.lit(False)), phase)
    return found.otherwise(F.lit(None).cast("string"))


def evidence(events: DataFrame, min_bytes: int = 1_000_000, min_rows: int = 5_000) -> DataFrame:
    """``client_ip, ts, phase`` of the events with an address that are evidence of a phase."""
    marked = _addressed(events).select("client_ip", "ts", attack_phase(min_bytes, min_rows).alias("phase"))
    return marked.where("phase is not null and ts is not null")


def ordered_phases(
    marks: DataFrame, limit_seconds: int, bucket_seconds: int = 60, phases: Sequence[str] = PHASES, key: str = "client_ip", ts: str = "ts", min_hits: int = 1
) -> DataFrame:
    """Keys with a chain of all ``phases`` in order, from first to last within ``limit_seconds``.

    Time counts in buckets; a phase is reached in a bucket with ``min_hits`` of its marks, and phases within one bucket count as in order.
    ``finished`` is the bucket of the first chain in time, ``started`` its latest possible start, ``chains`` the number of buckets that end one,
    and ``hits_<phase>`` all marks of the key.
    """
    bucket = F.floor(F.unix_micros(ts) / (bucket_seconds * 1_000_000)).cast("bigint")
    hits = [F.count_if(F.col("phase") == p).alias(f"hits_{p}") for p in phases]
    rows = marks.groupBy(key, bucket.alias("bucket")).agg(*hits)
    upto = Window.partitionBy(key).orderBy("bucket").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("start", F.when(F.col(f"hits_{phases[0]}") >= min_hits, F.col("bucket")))
    for phase in phases[1:]:
        # A chain that reaches this phase here starts best where the latest chain up to the phase before does.
        rows = rows.withColumn("carried", F.max("start").over(upto)).withColumn("start", F.when(F.col(f"hits_{phase}") >= min_hits, F.col("carried")))
    whole = F.col("start").isNotNull() & ((F.col("bucket") - F.col("start")) * bucket_seconds <= limit_seconds)
    found = rows.groupBy(key).agg(
        F.min(F.when(whole, F.struct("bucket", "start"))).alias("first"), F.count_if(whole).alias("chains"),
        *[F.sum(f"hits_{p}").alias(f"hits_{p}") for p in phases],
    )

    def at(column: str) -> Column:
        return F.timestamp_seconds(F.col(column) * bucket_seconds)

    return found.where("chains > 0").select(
        key, at("first.start").alias("started"), at("first.bucket").alias("finished"), "chains", *[f"hits_{p}" for p in phases]
    )
