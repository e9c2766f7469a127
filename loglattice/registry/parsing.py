"""Queries over raw messages: every kind rendered from all events, parsed back and compared with the facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglattice.functions.ip import in_range
from loglattice.functions.scalars import replace_pattern
from loglattice.operators import shares
from loglattice.plans.messages import classify, parse_messages
from loglattice.registry import rendered
from loglattice.registry.shared import AS_OF, HR, LINES, Query, load, sql_ts, text_ts
from loglattice.session import scratch_dir
from loglattice.sources import files

_MS, _SEC = sql_ts("ms_ts"), sql_ts("sec_ts")
_DIR = "'/api/v2/../../etc/passwd'"
_QUERY_PATH = "path || '?accountId=' || account"

# Per kind: output column to the fact it must equal. ``kv.x`` reads the key ``x`` of the parsed map.
EXPECTED: dict[str, dict[str, str]] = {
    "log4j": {"ts": _MS, "level": "lvl", "service": "'c.x.' || svc", "client_ip": "ip", "account_id": "account",
              "user_name": "usr", "duration_ms": "CAST(ms AS DOUBLE)", "kv.thread": "'exec-' || n12"},
    "nginx": {"ts": _SEC, "client_ip": "ip", "account_id": "account", "user_name": "usr", "http_method": "method",
              "url_path": _QUERY_PATH, "http_status": "status", "bytes": "size", "duration_ms": "CAST(ms AS DOUBLE)",
              "kv.agent": "'curl/8.7.1'"},
    "syslog": {"ts": _SEC, "service": "'sshd'", "client_ip": "ip", "user_name": "usr", "kv.host": "'app-0' || n3",
               "kv.pid": "CAST(200 + n12 AS VARCHAR)"},
    "haproxy": {"ts": _MS, "client_ip": "ip", "http_method": "method", "url_path": "path", "http_status": "status",
                "bytes": "size", "duration_ms": "CAST(ms AS DOUBLE)", "kv.backend": "'be_auth'",
                "kv.server": "'srv' || n3", "kv.t_response": "'4'"},
    "envoy": {"ts": _MS, "service": "svc || '.svc'", "client_ip": "ip", "http_method": "method", "url_path": "path",
              "http_status": "status", "bytes": "size", "duration_ms": "CAST(ms AS DOUBLE)", "kv.flags": "'-'",
              "kv.request_id": "'r' || id", "kv.upstream_ms": "CAST(ms // 2 AS VARCHAR)"},
    "kafka": {"ts": _MS, "level": "'INFO'", "kv.client_id": "'consumer-' || n3", "kv.topic": "event_type",
              "kv.partition": "CAST(n12 AS VARCHAR)", "kv.offset": "CAST(id AS VARCHAR)", "kv.lag": "CAST(ms AS VARCHAR)"},
    "postgres": {"ts": _MS, "level": "'LOG'", "user_name": "usr", "duration_ms": "ms + CAST(0.5 AS DOUBLE)",
                 "kv.database": "'ledger_api'", "kv.pid": "CAST(1000 + n12 AS VARCHAR)"},
    "cef": {"ts": _SEC, "client_ip": "ip", "user_name": "usr", "kv.signature": "'101'", "kv.name": "'Failed Login'",
            "kv.severity": "CAST(n12 AS VARCHAR)", "kv.outcome": "'failure'",
            "account_id": "CASE WHEN n3 <> 0 THEN account END", "bytes": "CASE WHEN n3 = 0 THEN size END"},
    "hikari": {"ts": _MS, "kv.host": "'app-0' || n3", "kv.total": "'50'", "kv.active": "CAST(38 + n12 AS VARCHAR)",
               "kv.idle": "CAST(12 - n12 AS VARCHAR)", "kv.waiting": "CAST(ms AS VARCHAR)"},
    "gc": {"ts": _MS, "kv.gc_no": "CAST(id AS VARCHAR)", "kv.before_mb": "CAST(4000 + n12 AS VARCHAR)",
           "kv.after_mb": "CAST(2000 + n12 AS VARCHAR)", "kv.heap_mb": "'8192'",
           "duration_ms": "ms + CAST(0.25 AS DOUBLE)"},
    "iis": {"ts": _SEC, "client_ip": "ip", "account_id": "account", "http_method": "method", "url_path": "path",
            "http_status": "status", "duration_ms": "CAST(ms AS DOUBLE)", "kv.server_ip": "'10.42.3.22'"},
    "redis": {"ts": _MS, "client_ip": "ip", "kv.pid": "CAST(100 + n12 AS VARCHAR)"},
    "waf": {"ts": _SEC, "client_ip": "ip", "level": "'CRITICAL'", "account_id": "account", "http_method": "method",
            "url_path": "path", "http_status": "CAST(403 AS INTEGER)", "kv.rule_id": "CAST(942100 + n3 AS VARCHAR)",
            "kv.data": _QUERY_PATH},
    "stacktrace": {"ts": _MS, "level": "'ERROR'", "service": "'c.x.' || svc", "client_ip": "ip", "account_id": "account",
                   "kv.exception": "'java.net.SocketTimeoutException'", "kv.exception_message": "'Read timed out'",
                   "frames": "CASE WHEN n3 = 0 THEN 'a.B.c(B.java:1)|d.E.f(E.java:2)' ELSE 'a.B.c(B.java:1)' END",
                   "caused_by": "CASE WHEN n3 = 0 THEN 'x.Reset' END"},
    "jsonish": {"ts": _MS, "level": "lvl", "service": "svc", "client_ip": "ip", "account_id": "account",
                "http_status": "status", "duration_ms": "CAST(ms AS DOUBLE)"},
    "otel_span": {"ts": _MS, "service": "svc", "client_ip": "ip", "account_id": "account", "user_name": "usr",
                  "http_method": "method", "url_path": "path", "http_status": "status",
                  "duration_ms": "CAST(ms AS DOUBLE)"},
    "audit_event": {"ts": _MS, "client_ip": "ip", "account_id": "account", "user_name": "usr"},
    "payment_auth": {"ts": _MS, "client_ip": "ip", "account_id": "account"},
}


def _column(name: str):
    return F.col("kv").getItem(name[3:]).alias(name[3:]) if name.startswith("kv.") else F.col(name)


def _parse(kind: str):
    def run(spark, sf):
        (facts,) = load(spark, sf, "line_facts")
        parsed = parse_messages(rendered.messages(facts, kind, "id"), AS_OF)
        out = text_ts(parsed.select("id", "kind", *[_column(c) for c in EXPECTED[kind]]), "ts")
        return out.withColumn("frames", F.array_join("frames", "|")) if "frames" in out.columns else out

    columns = ", ".join(f"{fact} AS {name.removeprefix('kv.')}" for name, fact in EXPECTED[kind].items())
    return run, f"SELECT id, '{kind}' AS kind, {columns} FROM {LINES} AS f"


_SLOTS = len(rendered.KINDS) + 2
_KIND_CASE = (
    "CASE id % " + str(_SLOTS) + " "
    + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(rendered.KINDS))
    + f" WHEN {_SLOTS - 2} THEN 'json_other' ELSE 'unknown' END"
)
_HAS_IP = "('hikari', 'gc', 'kafka', 'postgres', 'json_other', 'unknown')"


def kind_counts(spark, sf):
    (facts,) = load(spark, sf, "line_facts")
    kinds = rendered.mixed(facts).select(F.octet_length("message").alias("size"), classify("message").alias("kind"))
    return shares.share_of_total(kinds, "kind").select("kind", "n", F.round("share", 6).alias("share"))


def client_ip_counts(spark, sf):
    (facts,) = load(spark, sf, "line_facts")
    parsed = parse_messages(rendered.mixed(facts, "id"), AS_OF)
    return (
        parsed.where(F.col("client_ip").isNotNull())
        .groupBy("client_ip", in_range("client_ip").alias("is_client_range"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def messages_from_parquet(spark, sf):
    """Messages stored as Parquet, as a log shipper leaves them, then read and parsed."""
    (facts,) = load(spark, sf, "line_facts")
    path = scratch_dir(spark, "messages")
    files.write_parquet(rendered.mixed(facts).select("message"), path)
    parsed = parse_messages(files.read_messages(spark, path), AS_OF)
    found = parsed.where(F.col("client_ip").isNotNull())
    return found.groupBy("client_ip", in_range("client_ip").alias("is_client_range")).agg(F.count(F.lit(1)).alias("n"))


def order_share(spark, sf):
    # Log messages and order documents in one dataset, as they are stored.
    facts, orders = load(spark, sf, "line_facts", "order_facts")
    both = rendered.mixed(facts).unionByName(rendered.orders(orders))
    kinds = both.select(classify("message").alias("kind"), "message")
    return shares.conditional_share(
        kinds, {"orders": F.col("kind") == "order", "passwd_lines": F.col("message").contains("/etc/passwd")}
    )


def roster_csv(spark, sf):
    (hr,) = load(spark, sf, "hr")
    path = scratch_dir(spark, "roster")
    files.write_roster(hr, path)
    return files.read_roster(spark, path)


def roster_parquet(spark, sf):
    (hr,) = load(spark, sf, "hr")
    path = scratch_dir(spark, "roster")
    files.write_roster(hr, path, "parquet")
    return files.read_roster(spark, path, "parquet")


def text_replace(spark, sf):
    # Insert a missing clause with a look-ahead, only where it is absent.
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select(
        "doc_id", replace_pattern("text", r"^(\s*+[a-z0-9_]++)(?!\s+\[noted\])", "$1 [noted]", "im").alias("text")
    )


_MIXED_PATH_KINDS = "('nginx', 'haproxy', 'envoy', 'iis', 'waf', 'otel_span')"

_CLIENT_IP_SQL = (
    "SELECT ip AS client_ip, CAST(split_part(ip, '.', 2) AS INT) BETWEEN 31 AND 49 AS is_client_range, "
    f"count(*) AS n FROM (SELECT ip, {_KIND_CASE} AS kind FROM {LINES} AS f) AS k "
    f"WHERE kind NOT IN {_HAS_IP} GROUP BY ALL"
)

QUERIES: dict[str, tuple[Query, str | None]] = {f"parse_{k}": _parse(k) for k in EXPECTED}
QUERIES |= {
    "kind_counts": (
        kind_counts,
        f"SELECT kind, count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (), 6) AS share "
        f"FROM (SELECT {_KIND_CASE} AS kind FROM {LINES} AS f) AS k GROUP BY kind",
    ),
    "client_ip_counts": (client_ip_counts, _CLIENT_IP_SQL),
    "messages_from_parquet": (messages_from_parquet, _CLIENT_IP_SQL),
    "order_share": (
        order_share,
        f"""SELECT n AS checked, o AS orders, p AS passwd_lines, round(o * 100.0 / greatest(1, n), 4) AS orders_pct,
  round(p * 100.0 / greatest(1, n), 4) AS passwd_lines_pct
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE kind = 'order') AS o,
        count(*) FILTER (WHERE kind IN {_MIXED_PATH_KINDS} AND path LIKE '%/etc/passwd%') AS p
      FROM (SELECT {_KIND_CASE} AS kind, path FROM {LINES} AS f UNION ALL SELECT 'order', NULL FROM orders) AS u) AS c""",
    ),
    "roster_csv": (roster_csv, f"SELECT * FROM {HR} AS h"),
    "roster_parquet": (roster_parquet, f"SELECT * FROM {HR} AS h"),
    "text_replace": (
        # No given text holds the clause yet, so the look-ahead never blocks.
        text_replace,
        r"SELECT doc_id, regexp_replace(text, '(?im)^(\s*[a-z0-9_]+)', '\1 [noted]', 'g') AS text FROM documents",
    ),
}
