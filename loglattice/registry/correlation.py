"""Correlation, look-up and enrichment queries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from loglattice.operators import correlate as C
from loglattice.operators import enrich as E
from loglattice.operators.writeback import update_documents
from loglattice.registry.shared import ALERTS, AS_OF, HR, LOGS, Query, joined, listed, load, valid_ip
from loglattice.session import scratch_dir
from loglattice.sources import files

IP = "10.31.0.42"
ATTRS = C.ROSTER_ATTRIBUTES
RANGE = (datetime(2024, 1, 10, tzinfo=timezone.utc), datetime(2024, 1, 20, 12, tzinfo=timezone.utc))


def netflow(spark, sf):
    logs, hr = load(spark, sf, "logs", "hr")
    return joined(C.netflow_roster(logs, hr), ["first_name", "department", "sub_department", "start_date"])


def five_modules(spark, sf):
    logs, hr = load(spark, sf, "logs", "hr")
    return joined(C.five_module_roster(logs, hr, IP), ATTRS)


def five_modules_all(spark, sf):
    logs, hr = load(spark, sf, "logs", "hr")
    return joined(C.five_module_roster(logs, hr), ATTRS)


def documents(spark, sf):
    logs, hr = load(spark, sf, "logs", "hr")
    return joined(C.document_roster(logs, hr), [*ATTRS, "dataset", "index"])


def document_ids(spark, sf):
    logs, hr = load(spark, sf, "logs", "hr")
    return C.documents_of(C.document_roster(logs, hr), logs)


def lookup_ids(spark, sf):
    logs, hr = load(spark, sf, "logs", "hr")
    return C.documents_of(C.lookup_exact(logs, hr, IP), logs.where(F.col("client_ip") == IP))


def any_ip_ids(spark, sf):
    logs, hr = load(spark, sf, "logs", "hr")
    return C.documents_of(C.lookup_any_ip(logs, hr, IP), C.documents_at(logs, IP))


def _lookup(operator, lists):
    def run(spark, sf):
        logs, hr = load(spark, sf, "logs", "hr")
        return joined(operator(logs, hr, IP), lists)

    return run


def _grouped(log_side: str, hr_where: str, tag: str, counts: dict[str, str], lists: dict[str, str], having: str) -> str:
    outs = ", ".join([f"count(*) FILTER (WHERE {c}) AS {n}" for n, c in counts.items()])
    vals = ", ".join(listed(f'"{src}"', f'"{out}"') for out, src in lists.items())
    nulls = ", ".join(f"CAST(NULL AS VARCHAR) AS {a}" for a in ATTRS)
    return f"""
WITH u AS (
  SELECT client_ip, event_module, _id, _index, {nulls} FROM {log_side}
  UNION ALL
  SELECT {valid_ip("ip_address")}, NULL, NULL, NULL, {", ".join(ATTRS)} FROM {HR} AS h WHERE {hr_where}
), t AS (SELECT *, CASE {tag} ELSE 'Other' END AS data_type FROM u)
SELECT client_ip, {outs}, {vals} FROM t GROUP BY client_ip HAVING {having}
"""


_ALL = f"{LOGS} AS l WHERE client_ip IS NOT NULL"
_HR_TAG = "WHEN department IS NOT NULL THEN 'HR'"
_DOC_TAG = f"WHEN event_module IS NOT NULL THEN 'Dataset' WHEN _id IS NOT NULL THEN 'Doc_ID' {_HR_TAG}"
_FIVE_TAG = (
    "WHEN event_module = 'network_traffic' THEN 'Netflow' WHEN event_module = 'proxysg' THEN 'Proxy' "
    "WHEN event_module = 'email' THEN 'Email' WHEN event_module = 'ti_abusech' THEN 'Threat-Intel' "
    f"WHEN event_module = 'system' THEN 'Windows' {_HR_TAG}"
)
_FIVE = "data_type IN ('Netflow', 'Proxy', 'Email', 'Threat-Intel', 'Windows')"
_BOTH = "log_events > 0 AND hr_matches > 0"
_NAMES = {a: a for a in ATTRS}
_DOC_LISTS = {**_NAMES, "dataset": "event_module", "index": "_index"}
_ANY = " OR ".join(f"{c} = '{IP}'" for c in ("client_ip", "host_ip", "destination_ip", "source_ip"))
_BY_PARAMETER = f"(SELECT * REPLACE ('{IP}' AS client_ip) FROM {LOGS} AS l WHERE {_ANY}) AS m"

# ---- enrichment ------------------------------------------------------------------------------------------------

_HR_FLAT = ["department", "sub_department", "start_date", "first_name", "last_name"]
_TIE = "last_name, first_name, department, sub_department, start_date"
_PEOPLE = f"""people AS (
  SELECT * FROM (
    SELECT {valid_ip("ip_address")} AS hr_ip, {", ".join(_HR_FLAT)},
      row_number() OVER (PARTITION BY ip_address ORDER BY {_TIE}) AS rn FROM {HR} AS h) AS p
  WHERE hr_ip IS NOT NULL AND rn = 1)"""


def _ranked_sql(docs: str, columns: str, where: str = "TRUE", extra: str = "") -> str:
    return f"""
WITH {_PEOPLE}, legs AS (
  SELECT _index, _id, rank, hr.* FROM (
    SELECT _index, _id, unnest([1, 2, 3]) AS rank, unnest([client_ip, source_ip, host_ip]) AS ip FROM {docs} AS d) AS x
  JOIN people AS hr ON x.ip = hr.hr_ip
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY _index, _id ORDER BY rank) AS pick FROM legs) AS l
  WHERE pick = 1)
SELECT {columns} FROM {docs} AS d LEFT JOIN best AS b ON d._index = b._index AND d._id = b._id {extra} WHERE {where}
"""


_ENRICHED = ", ".join(f"b.{c} AS {c}" for c in _HR_FLAT)
_ENRICH_COLS = f"d._index AS _index, d._id AS _id, CAST(b.rank AS INTEGER) AS match_rank, {_ENRICHED}"


def _flat(df, struct, fields, *keep):
    return df.select(*keep, *[F.col(f"{struct}.{f}").alias(f) for f in fields])


def ranked_logs(spark, sf):
    logs, hr = load(spark, sf, "logs", "hr")
    return _flat(E.enrich_logs(logs, hr), "enriched", _HR_FLAT, "_index", "_id", "match_rank")


def ranked_logs_shuffled(spark, sf):
    logs, hr = load(spark, sf, "logs", "hr")
    return _flat(E.enrich_logs(logs, hr, strategy="join"), "enriched", _HR_FLAT, "_index", "_id", "match_rank")


def ranked_dupes(spark, sf):
    """Documents with repeated and missing ids, by both look-up plans; ``plan`` says which."""
    logs, hr = load(spark, sf, "logs", "hr")
    n = F.regexp_extract("_id", "([0-9]+)$", 1).cast("bigint")
    docs = logs.withColumn("_id", F.when(n % 5 != 0, F.concat(F.lit("d"), n % 50)))
    both = [
        _flat(E.enrich_logs(docs, hr, strategy=way), "enriched", _HR_FLAT, "_id", "client_ip", "source_ip", "host_ip", "match_rank").withColumn("plan", F.lit(way))
        for way in ("broadcast", "join")
    ]
    return both[0].unionByName(both[1])


def ranked_alerts(spark, sf):
    alerts, hr = load(spark, sf, "alerts", "hr")
    old = F.struct(F.lit("old").alias("note"), F.lit("none").alias("department"))
    held = alerts.withColumn("enriched", F.when(F.col("event_module") == "email", old))
    return _flat(E.enrich_alerts(held, hr), "enriched", ["note", *_HR_FLAT], "_index", "_id", "match_rank")


def merged_alerts(spark, sf):
    alerts, hr = load(spark, sf, "alerts", "hr")
    old = F.struct(F.lit("old").alias("note"), F.lit("none").alias("department"))
    held = alerts.withColumn("enriched", F.when(F.col("event_module") == "email", old))
    updates = E.ranked_lookup(alerts, hr).where("match_rank is not null").select(
        "_index", "_id", E.enriched_struct(F.col("person")).alias("update")
    )
    return _flat(E.update_by_id(held, updates, "enriched", "merge"), "enriched", ["note", *_HR_FLAT], "_index", "_id")


_OLD_DEPT = "CASE WHEN b.rank IS NULL AND d.event_module = 'email' THEN 'none' ELSE b.department END AS department"
_REST = ", ".join(f"b.{c} AS {c}" for c in _HR_FLAT[1:])

_BULK_FLAT = ["ip_address", "first_name", "last_name", "full_name", "department", "sub_department", "start_date"]


def bulk_range(spark, sf):
    logs, hr = load(spark, sf, "logs", "hr")
    return _flat(E.any_match(logs, hr, *RANGE, AS_OF), "hr", _BULK_FLAT, "_index", "_id")


#: The end of the default window, which begins a day before.
_NOON = datetime(2024, 1, 15, 12, tzinfo=timezone.utc)


def bulk_default_window(spark, sf):
    logs, hr = load(spark, sf, "logs", "hr")
    return _flat(E.any_match(logs, hr, None, None, _NOON), "hr", _BULK_FLAT, "_index", "_id")


_BULK_SQL = f"""
WITH {_PEOPLE}, legs AS (
  SELECT _index, _id, hr.* FROM (
    SELECT _index, _id, unnest([client_ip, source_ip, host_ip]) AS ip FROM {LOGS} AS d
    WHERE event_ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00') AS x
  JOIN people AS hr ON x.ip = hr.hr_ip
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY _index, _id ORDER BY
      CAST(split_part(hr_ip, '.', 3) AS INT), CAST(split_part(hr_ip, '.', 4) AS INT)) AS pick FROM legs) AS l
  WHERE pick = 1)
SELECT d._index AS _index, d._id AS _id, b.hr_ip AS ip_address, b.first_name AS first_name, b.last_name AS last_name,
  b.first_name || ' ' || b.last_name AS full_name, b.department AS department, b.sub_department AS sub_department,
  b.start_date AS start_date
FROM {LOGS} AS d LEFT JOIN best AS b ON d._index = b._index AND d._id = b._id
"""


# Only these datasets get updates; the others must come through a write-back as they were.
_UPDATED = "('logs-signup', 'logs-purchase')"
_HELD = "event_module IN ('email', 'proxysg')"


def _stored_logs(spark, logs):
    path = scratch_dir(spark, "documents")
    files.write_partitions(logs, path, ["_index"])
    return path, logs.schema


def _written(mode):
    def run(spark, sf):
        logs, hr = load(spark, sf, "logs", "hr")
        old = F.struct(F.lit("old").alias("note"), F.lit("none").alias("department"))
        path, schema = _stored_logs(spark, logs.withColumn("enriched", F.when(F.expr(_HELD), old)))
        found = E.ranked_lookup(logs.where(f"_index IN {_UPDATED}"), hr).where("match_rank is not null")
        updates = found.select("_index", "_id", E.enriched_struct(F.col("person")).alias("update"))
        return _flat(update_documents(spark, path, schema, updates, "enriched", mode), "enriched", ["note", *_HR_FLAT], "_index", "_id")

    return run


def bulk_written(spark, sf):
    logs, hr = load(spark, sf, "logs", "hr")
    path, schema = _stored_logs(spark, logs)
    found = E.any_match(logs, hr, *RANGE, AS_OF).where("hr is not null")
    updates = found.select("_index", "_id", F.col("hr").alias("update"))
    return _flat(update_documents(spark, path, schema, updates, "hr", "replace"), "hr", _BULK_FLAT, "_index", "_id")


def _written_sql(note: str) -> str:
    kept = f"b.rank IS NULL AND d.{_HELD}"
    columns = f"d._index AS _index, d._id AS _id, CASE WHEN {note} THEN 'old' END AS note, CASE WHEN {kept} THEN 'none' ELSE b.department END AS department, {_REST}"
    return _ranked_sql(LOGS, columns, extra=f"AND d._index IN {_UPDATED}")


# Two datasets of one pattern in different formats; a third is there that the pattern must not take.
_IS_WEB = "_index IN ('logs-view', 'logs-click')"


def _datasets(spark, sf, first, second):
    """The log documents as two stored datasets: Parquet, and newline-delimited JSON."""
    (logs,) = load(spark, sf, "logs")
    rows = logs.drop("_index")
    chosen = lambda where: logs.where(where).drop("_index")
    web, rest = scratch_dir(spark, first), scratch_dir(spark, second)
    files.write_parquet(chosen(_IS_WEB), web)
    files.write_ndjson(files.results_json(chosen(f"NOT {_IS_WEB}"), "message"), rest)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return {
        first: lambda s: files.with_ids(s.read.schema(rows.schema).parquet(web), first),
        second: lambda s: files.with_ids(files.read_ndjson(s, rest, ddl), second),
        "other": lambda s: files.with_ids(s.read.schema(rows.schema).parquet(web), "other"),
    }


def logs_wildcard(spark, sf):
    (hr,) = load(spark, sf, "hr")
    logs = files.read_dataset(spark, "logs-*", _datasets(spark, sf, "logs-web", "logs-rest"))
    return joined(C.document_roster(logs, hr), [*ATTRS, "dataset", "index"])


def alerts_alias(spark, sf):
    (hr,) = load(spark, sf, "hr")
    stored = _datasets(spark, sf, "alerts-000001", "alerts-000002")
    alerts = files.read_dataset(spark, "alerts", stored, {"alerts": ["alerts-000001", "alerts-000002"]})
    return _flat(E.enrich_alerts(alerts, hr), "enriched", _HR_FLAT, "_index", "_id", "match_rank")


def _split_sql(first: str, second: str) -> str:
    return f"(SELECT * REPLACE (CASE WHEN {_IS_WEB} THEN '{first}' ELSE '{second}' END AS _index) FROM {LOGS} AS l)"


def by_ids(spark, sf):
    # Documents chosen by the alerts that fired on threat-intelligence matches.
    logs, alerts = load(spark, sf, "logs", "alerts")
    fired = alerts.where(F.col("event_module") == "ti_abusech")
    return E.select_docs(logs, alerts=fired).select("_index", "_id", "client_ip", "source_ip", "host_ip")


def untouched(spark, sf):
    logs, hr = load(spark, sf, "logs", "hr")
    return E.untouched_docs(logs, hr).select("_index", "_id", "client_ip", "source_ip", "host_ip")


_NETFLOW_LISTS = {a: a for a in ("first_name", "department", "sub_department", "start_date")}

QUERIES: dict[str, tuple[Query, str | None]] = {
    "logs_n_hr": (
        netflow,
        _grouped(
            _ALL, "TRUE", f"WHEN event_module = 'network_traffic' THEN 'Netflow' {_HR_TAG}",
            {"log_events": "data_type = 'Netflow'", "hr_matches": "data_type = 'HR'"}, _NETFLOW_LISTS, _BOTH,
        ),
    ),
    "ip_search": (
        five_modules,
        _grouped(_ALL, "TRUE", _FIVE_TAG, {"log_events": _FIVE, "hr_matches": "data_type = 'HR'"}, _NAMES,
                 f"{_BOTH} AND client_ip = '{IP}'"),
    ),
    "ip_search_all": (
        five_modules_all,
        _grouped(_ALL, "TRUE", _FIVE_TAG, {"log_events": _FIVE, "hr_matches": "data_type = 'HR'"}, _NAMES, _BOTH),
    ),
    "good_asof": (
        documents,
        _grouped(_ALL, "TRUE", _DOC_TAG, {"log_events": "data_type = 'Dataset'", "hr_matches": "data_type = 'HR'"},
                 _DOC_LISTS, _BOTH),
    ),
    "good_asof_ids": (
        document_ids,
        f"SELECT DISTINCT client_ip, _id FROM {_ALL} AND client_ip IN (SELECT client_ip FROM {LOGS} AS m WHERE event_module IS NOT NULL) "
        f"AND client_ip IN (SELECT {valid_ip('ip_address')} FROM {HR} AS h WHERE department IS NOT NULL)",
    ),
    "hr_lookup_ids": (
        lookup_ids,
        f"SELECT DISTINCT client_ip, _id FROM {LOGS} AS l WHERE client_ip = '{IP}' AND '{IP}' IN (SELECT ip_address FROM {HR} AS h WHERE department IS NOT NULL)",
    ),
    "lookup_any_ip_ids": (
        any_ip_ids,
        f"SELECT DISTINCT '{IP}' AS client_ip, _id FROM {LOGS} AS l WHERE ({_ANY}) AND '{IP}' IN (SELECT ip_address FROM {HR} AS h WHERE department IS NOT NULL)",
    ),
    "hr_lookup": (
        _lookup(C.lookup_exact, [*ATTRS, "index"]),
        _grouped(f"{LOGS} AS l WHERE client_ip = '{IP}'", f"ip_address = '{IP}'",
                 f"WHEN event_module IS NOT NULL THEN 'Datasets' {_HR_TAG}",
                 {"log_events": "data_type IS NOT NULL", "hr_matches": "data_type = 'HR'"},
                 {**_NAMES, "index": "_index"}, _BOTH),
    ),
    "lookup_v5_exact": (
        _lookup(C.lookup_v5_exact, [*ATTRS, "dataset", "index"]),
        _grouped(f"{LOGS} AS l WHERE {_ANY}", f"ip_address = '{IP}'", _DOC_TAG,
                 {"log_events": "data_type IS NOT NULL", "hr_matches": "data_type = 'HR'"}, _DOC_LISTS, _BOTH),
    ),
    "lookup_any_ip": (
        _lookup(C.lookup_any_ip, [*ATTRS, "dataset", "index"]),
        _grouped(_BY_PARAMETER, f"ip_address = '{IP}'", _DOC_TAG,
                 {"log_events": "data_type IS NOT NULL", "hr_matches": "data_type = 'HR'"}, _DOC_LISTS, _BOTH),
    ),
    "ranked_enrich_logs": (ranked_logs, _ranked_sql(LOGS, _ENRICH_COLS)),
    "ranked_enrich_logs_large_roster": (ranked_logs_shuffled, _ranked_sql(LOGS, _ENRICH_COLS)),
    "ranked_enrich_dupes": (
        ranked_dupes,
        f"""WITH {_PEOPLE}, d AS (SELECT *, CAST(regexp_extract(_id, '([0-9]+)$', 1) AS BIGINT) AS n FROM {LOGS} AS l)
SELECT CASE WHEN n % 5 <> 0 THEN 'd' || (n % 50) END AS _id, client_ip, source_ip, host_ip, plan,
  CAST(CASE WHEN c.hr_ip IS NOT NULL THEN 1 WHEN s.hr_ip IS NOT NULL THEN 2 WHEN h.hr_ip IS NOT NULL THEN 3 END AS INTEGER) AS match_rank,
  {", ".join(f"CASE WHEN c.hr_ip IS NOT NULL THEN c.{x} WHEN s.hr_ip IS NOT NULL THEN s.{x} ELSE h.{x} END AS {x}" for x in _HR_FLAT)}
FROM d LEFT JOIN people AS c ON d.client_ip = c.hr_ip LEFT JOIN people AS s ON d.source_ip = s.hr_ip LEFT JOIN people AS h ON d.host_ip = h.hr_ip,
  (VALUES ('broadcast'), ('join')) AS w(plan)""",
    ),
    "ranked_enrich_alerts": (
        ranked_alerts,
        _ranked_sql(
            ALERTS,
            "d._index AS _index, d._id AS _id, CAST(b.rank AS INTEGER) AS match_rank, "
            f"CASE WHEN b.rank IS NULL AND d.event_module = 'email' THEN 'old' END AS note, {_OLD_DEPT}, {_REST}",
        ),
    ),
    "merge_enrich_alerts": (
        merged_alerts,
        _ranked_sql(
            ALERTS,
            "d._index AS _index, d._id AS _id, "
            f"CASE WHEN d.event_module = 'email' THEN 'old' END AS note, {_OLD_DEPT}, {_REST}",
        ),
    ),
    "bulk_enrich_range": (bulk_range, _BULK_SQL),
    "bulk_enrich_default_window": (
        bulk_default_window, _BULK_SQL.replace("2024-01-10 00:00:00", "2024-01-14 12:00:00").replace("2024-01-20 12:00:00", "2024-01-15 12:00:00"),
    ),
    "enrich_written_merge": (_written("merge"), _written_sql(f"d.{_HELD}")),
    "enrich_written_replace": (_written("replace"), _written_sql(f"b.rank IS NULL AND d.{_HELD}")),
    "bulk_enrich_written": (bulk_written, _BULK_SQL),
    "logs_wildcard": (
        logs_wildcard,
        _grouped(f"{_split_sql('logs-web', 'logs-rest')} AS s WHERE client_ip IS NOT NULL", "TRUE", _DOC_TAG,
                 {"log_events": "data_type = 'Dataset'", "hr_matches": "data_type = 'HR'"}, _DOC_LISTS, _BOTH),
    ),
    "alerts_alias": (alerts_alias, _ranked_sql(_split_sql("alerts-000001", "alerts-000002"), _ENRICH_COLS)),
    "select_by_ids": (
        by_ids,
        f"SELECT _index, _id, client_ip, source_ip, host_ip FROM {LOGS} AS l "
        f"WHERE _id IN (SELECT _id FROM {ALERTS} AS a WHERE event_module = 'ti_abusech')",
    ),
    "untouched_docs": (
        untouched,
        _ranked_sql(LOGS, "d._index, d._id, d.client_ip, d.source_ip, d.host_ip", "b.rank IS NULL"),
    ),
}
