"""Archive, audit and nested-document queries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from loglattice.functions.scalars import business_hour, hour_band, iso_millis, season_factor
from loglattice.operators import shares
from loglattice.plans import audits, documents, rollups
from loglattice.registry import derived, rendered
from loglattice.registry.shared import AS_OF, LINES, LOGS, ORDERS, TX, Query, load, sql_ts, text_ts
from loglattice.session import scratch_dir
from loglattice.sources import files

STAFF = derived.sql("staff")

# ---- transactions ----------------------------------------------------------------------------------------------


def _cents(value: str) -> str:
    return f"CAST({value} AS DECIMAL(18,2))"


def _stored(spark, sf):
    """The transactions written under year= and month= folders and read back."""
    (tx,) = load(spark, sf, "transactions")
    path = scratch_dir(spark, "transactions")
    stored = tx.select(
        "accountID", "event_amount", "event_type", "account_type", "account_event", "timestamp", "year", "month"
    )
    files.write_partitions(stored, path, ["year", "month"], sort_by="timestamp")
    return files.read_transactions(spark, path)


def tx_rollup(spark, sf):
    (tx,) = load(spark, sf, "transactions")
    return rollups.transaction_rollup(tx, "account_type", "account_event", "year", "month")


def tx_pruned_month(spark, sf):
    start, end = datetime(1997, 11, 1, tzinfo=timezone.utc), datetime(1998, 2, 15, tzinfo=timezone.utc)
    return rollups.transaction_rollup(files.months_between(_stored(spark, sf), start, end), "year", "month")


def tx_hours_band(spark, sf):
    (logs,) = load(spark, sf, "logs")
    return logs.groupBy(
        hour_band("event_ts").alias("band"), business_hour("event_ts").alias("business")
    ).agg(F.count(F.lit(1)).alias("n"))


def dept_share(spark, sf):
    (staff,) = load(spark, sf, "staff")
    out = audits.department_mix(staff, 0.02)
    return out.select("department", "n", F.round("share", 6).alias("share"), "expected", "within")


def subdept_share(spark, sf):
    (staff,) = load(spark, sf, "staff")
    out = audits.sub_department_mix(staff, 0.02)
    return out.select("department", "sub_department", "n", F.round("share", 6).alias("share"), "within")


def profile_tx(spark, sf):
    (tx,) = load(spark, sf, "transactions")
    out = shares.profile(tx, "timestamp", "account_event", {"accounts": "accountID", "events": "account_event"})
    return text_ts(out, "first_ts", "last_ts")


#: Columns that some inquiries carry although only other events may, and their value.
_FILLERS = {"posID": 1, "txbankId": 1, "intbankID": 1, "to_account": 1, "wire_direction": "inbound"}

# An unknown event, a withdrawal of a security, a purchase with a trade id.
_UNKNOWN = "(account_event = 'fee' AND k % 103 = 0)"
_STRAY_SYMBOL = "(account_event = 'withdrawal' AND k % 109 = 0)"
_STRAY_TRADE = "(account_event = 'purchase' AND k % 113 = 0)"


def _damaged_tx(spark, sf):
    (tx,) = load(spark, sf, "transactions")
    k = F.col("k")
    traded, idle = F.col("account_event").isin("buy", "sell"), F.col("account_event") == "inquiry"
    unknown, symbol, trade = F.expr(_UNKNOWN), F.expr(_STRAY_SYMBOL), F.expr(_STRAY_TRADE)
    return tx.withColumns(
        {
            "transaction_date": F.when(k % 53 == 0, F.lit("1970-01-01T00:00:00.000Z")).otherwise(iso_millis("timestamp")),
            "settlement_date": F.when(
                traded | ((F.col("account_event") == "inquiry") & (k % 59 == 0)),
                F.date_format(F.date_add("timestamp", F.when(k % 59 == 0, 5).otherwise(2)), "yyyy-MM-dd"),
            ),
            **{c: F.when(idle & (k % 101 == 0), F.lit(filler)).otherwise(F.col(c)) for c, filler in _FILLERS.items()},
            "quantity": F.col("quantity") + F.when(k % 61 == 0, 1).otherwise(0),
            "addressId": F.when(k % 67 != 0, F.col("addressId")),
            "year": F.col("year") + F.when(k % 71 == 0, 1).otherwise(0),
            "account_event": F.when(unknown, F.lit("gift")).otherwise(F.col("account_event")),
            "security_symbol": F.when(symbol, F.lit("SYM0")).otherwise(F.col("security_symbol")),
            "tradeID": F.when(trade, F.concat(F.lit("TRD-"), F.year("timestamp"), F.lit("00000001"))).when(k % 73 != 0, F.when(k % 97 == 0, F.concat(F.lit("X"), "tradeID")).otherwise(F.col("tradeID"))),
            "deposit_type": F.when(k % 79 == 0, F.lit("cash")).otherwise(F.col("deposit_type")),
            "event_type": F.when(k % 83 == 0, F.lit("credit")).otherwise(F.col("event_type")),
            "event_amount": F.col("event_amount")
            + F.when((k % 89 == 0) & (F.col("account_event") == "inquiry"), 1).otherwise(0),
        }
    )


def audit_tx(spark, sf):
    return audits.audit_transactions(_damaged_tx(spark, sf))


def _rule_sql(source: str, rules: dict[str, tuple[str, str]]) -> str:
    """Per rule (rows it applies to, rows that break it), in one pass."""
    aggs = ", ".join(
        f"count(*) FILTER (WHERE {where}) AS c{i}, count(*) FILTER (WHERE ({where}) AND ({broken})) AS v{i}"
        for i, (where, broken) in enumerate(rules.values())
    )
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, c{i} AS checked, v{i} AS violations FROM a" for i, name in enumerate(rules)
    )
    return f"WITH a AS (SELECT {aggs} FROM {source} AS s) {rows}"


_TRADED = "account_event IN ('buy', 'sell')"
_IDLE = "account_event = 'inquiry'"
_TX_RULES = {
    "trade_quantity": (_TRADED, "k % 61 = 0"),
    "trade_fields": ("TRUE", f"({_TRADED} AND k % 73 = 0) OR {_STRAY_SYMBOL} OR {_STRAY_TRADE}"),
    "trade_id": (f"({_TRADED} AND k % 73 <> 0) OR {_STRAY_TRADE}", f"{_TRADED} AND k % 97 = 0"),
    "direction": ("TRUE", f"k % 83 = 0 AND account_event IN ('purchase', 'withdrawal', 'fee', 'buy', 'inquiry') AND NOT {_UNKNOWN}"),
    "zero_inquiry": ("account_event = 'inquiry'", "k % 89 = 0"),
    "address": ("accountID <= 35000", "k % 67 = 0"),
    "date_text": ("TRUE", "k % 53 = 0"),
    "settlement": ("TRUE", f"(k % 59 = 0 AND ({_TRADED} OR {_IDLE})) OR {_STRAY_SYMBOL}"),
    "partition": ("TRUE", "k % 71 = 0"),
    "known_event": ("TRUE", _UNKNOWN),
    "only_posID": (f"posID IS NOT NULL OR ({_IDLE} AND k % 101 = 0)", _IDLE),
    "only_deposit_type": ("account_event = 'deposit' OR k % 79 = 0", "account_event <> 'deposit'"),
    "only_txbankId": (f"txbankId IS NOT NULL OR ({_IDLE} AND k % 101 = 0)", _IDLE),
    "only_wire_direction": (f"wire_direction IS NOT NULL OR ({_IDLE} AND k % 101 = 0)", _IDLE),
    "only_intbankID": (f"intbankID IS NOT NULL OR ({_IDLE} AND k % 101 = 0)", _IDLE),
    "only_to_account": (f"to_account IS NOT NULL OR ({_IDLE} AND k % 101 = 0)", _IDLE),
    "only_security_symbol": (f"security_symbol IS NOT NULL OR {_STRAY_SYMBOL}", _STRAY_SYMBOL),
    "only_tradeID": (f"({_TRADED} AND k % 73 <> 0) OR {_STRAY_TRADE}", _STRAY_TRADE),
}


def persona_profile(spark, sf):
    (tx,) = load(spark, sf, "transactions")
    return audits.persona_profile(tx)


# Large amounts of persona accounts are cut down, but for one account, whose amounts are raised.
_UNREMARKABLE = f"""CASE WHEN accountID = 14 THEN event_amount * 2 + 5000 WHEN accountID IN ({", ".join(map(str, audits.PERSONA_ACCOUNTS))}) AND event_amount > 2500
  THEN event_amount * 0.125 ELSE event_amount END"""


def audit_personas(spark, sf):
    (tx,) = load(spark, sf, "transactions")
    out = audits.audit_personas(tx.withColumn("event_amount", F.expr(_UNREMARKABLE)))
    return out.withColumns({c: F.round(c, 9) for c in ("above", "below", "critical")})


_PERSONAS = ", ".join(map(str, audits.PERSONA_ACCOUNTS))

# ---- roster ----------------------------------------------------------------------------------------------------


def audit_roster(spark, sf):
    (staff,) = load(spark, sf, "staff")
    return audits.audit_roster(staff)


def roster_range(spark, sf):
    (staff,) = load(spark, sf, "staff")
    return audits.roster_range(staff)


_SUB_BAD = "department = 'marketing' AND sub_department = 'other'"
_ROSTER_RULES = {
    "valid_ip": ("TRUE", "ip_address = 'not-an-ip'"),
    "hire_window": ("TRUE", "start_date = '2031-01-01'"),
    "department": ("TRUE", "department = 'unknown'"),
    "sub_department": ("department <> 'unknown'", _SUB_BAD),
}
_MIX = "CASE department " + " ".join(
    f"WHEN '{d}' THEN CAST({p} AS DOUBLE) / 100" for d, p in audits.DEPARTMENT_MIX.items()
) + " END"
_SUB_MIX = "CASE " + " ".join(
    f"WHEN department = '{d}' AND sub_department = '{s}' THEN CAST({w} AS DOUBLE) / {sum(mix.values())}"
    for d, mix in audits.SUB_DEPARTMENT_MIX.items()
    for s, w in mix.items()
) + " END"

# ---- orders ----------------------------------------------------------------------------------------------------


def _orders(spark, sf, *keep):
    (facts,) = load(spark, sf, "order_facts")
    return documents.parsed(rendered.orders(facts, *keep), documents.ORDER_DDL)


def audit_orders(spark, sf):
    return audits.audit_orders(documents.flatten_order(_orders(spark, sf)), AS_OF)


#: A time among the orders, so that some of them are younger than a day, three days and ten days.
YOUNG = datetime(1995, 6, 17, 12, tzinfo=timezone.utc)


def audit_orders_young(spark, sf):
    return audits.audit_orders(documents.flatten_order(_orders(spark, sf)), YOUNG)


_RET = "status = 'returned' OR k % 139 = 0"
_JPY = "country = 'Japan' AND k % 127 <> 0"
_ORDER_RULES = {
    "total": ("TRUE", "k % 101 = 0"),
    "currency_by_country": ("TRUE", "k % 127 = 0"),
    "carrier_by_country": ("TRUE", "k % 131 = 0"),
    "city_by_country": ("TRUE", "k % 151 = 0"),
    "usd": ("TRUE", "k % 103 = 0"),
    "whole_currency": (_JPY, "(total_c + CASE WHEN k % 101 = 0 THEN 300 ELSE 0 END) % 100 <> 0"),
    "time_order": ("TRUE", "(k % 107 = 0 OR k % 167 = 0) AND status <> 'cancelled'"),
    "return_after_delivery": (_RET, "status <> 'returned'"),
    "status_by_age": ("TRUE", "FALSE"),
    "payment_status": ("TRUE", "k % 109 = 0"),
    "card_presence": ("TRUE", "k % 113 = 0"),
    "cross_border": ("TRUE", "k % 137 = 0"),
    "refund_amount": (_RET, "k % 101 = 0 OR k % 149 = 0"),
    "restocking_fee": (_RET, f"k % 2 = 1 AND k % 101 = 0 AND NOT ({_JPY})"),
    "order_id": ("TRUE", "k % 157 = 0"),
    "customer_id": ("TRUE", "k % 163 = 0"),
    "rma": (_RET, "k % 173 = 0"),
}
_AGE = "floor((epoch(TIMESTAMP '1995-06-17 12:00:00') - epoch(placed)) / 86400)"
_TOO_EARLY = f"""CASE WHEN {_AGE} < 1 THEN TRUE WHEN {_AGE} < 3 THEN status <> 'cancelled'
  WHEN {_AGE} < 10 THEN status NOT IN ('delivered', 'cancelled') ELSE FALSE END"""
_USD = (
    "round((total_c + CASE WHEN k % 101 = 0 THEN 300 ELSE 0 END) / 100 * fx, 2) "
    "+ CASE WHEN k % 103 = 0 THEN 900 ELSE 0 END"
)


def order_revenue(spark, sf):
    flat = documents.flatten_order(_orders(spark, sf)).withColumn("year", F.year("placed_at"))
    return rollups.order_revenue(flat, "country", "category", "tier", "channel", "year")


def order_shipping(spark, sf):
    events = documents.explode_shipping(_orders(spark, sf))
    return events.groupBy("event", "country").agg(
        F.count(F.lit(1)).alias("n"), F.date_format(F.max("at"), "yyyy-MM-dd").alias("last_day")
    )


def order_tags(spark, sf):
    return documents.tag_counts(documents.flatten_order(_orders(spark, sf)))


def order_ndjson(spark, sf):
    (facts,) = load(spark, sf, "order_facts")
    path = scratch_dir(spark, "orders")
    pretty = rendered.orders(facts).select(F.regexp_replace("message", ',"status"', ',\n"status"').alias("message"))
    files.write_ndjson(pretty, path)
    docs = files.read_ndjson(spark, path, documents.ORDER_DDL)
    return docs.groupBy(F.col("customer.tier").alias("tier"), "status").agg(F.count(F.lit(1)).alias("n"))


def order_regions(spark, sf):
    flat = documents.flatten_order(_orders(spark, sf))
    return flat.groupBy("country", "region").agg(F.count(F.lit(1)).alias("n"))


def season(spark, sf):
    flat = documents.flatten_order(_orders(spark, sf))
    lift = audits.seasonal_lift(flat)
    date = F.make_date(F.lit(2024), F.col("month"), F.lit(1))
    return lift.select(
        "month", "n", F.round("lift", 6).alias("lift"), season_factor(date).alias("factor")
    )


def results_json(spark, sf):
    (logs,) = load(spark, sf, "logs")
    out = logs.groupBy("event_module").agg(F.count(F.lit(1)).alias("n"))
    return files.results_json(out)


# ---- telemetry documents ---------------------------------------------------------------------------------------


def _docs(spark, sf, kind, ddl):
    (facts,) = load(spark, sf, "line_facts")
    return documents.parsed(rendered.messages(facts, kind, "id"), ddl)


def span_flat(spark, sf):
    flat = documents.flatten_span(_docs(spark, sf, "otel_span", documents.SPAN_DDL))
    return text_ts(flat, "started_at").drop("status_message", "name")


def span_events(spark, sf):
    events = documents.explode_events(_docs(spark, sf, "otel_span", documents.SPAN_DDL))
    return events.groupBy("event", "exception_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("db_rows").alias("db_rows"), F.count_distinct("span_id").alias("spans")
    )


def span_links(spark, sf):
    return documents.explode_links(_docs(spark, sf, "otel_span", documents.SPAN_DDL))


def span_tree(spark, sf):
    flat = documents.flatten_span(_docs(spark, sf, "otel_span", documents.SPAN_DDL))
    return documents.span_tree(flat).select("id", "span_id", "parent_span_id", "parent_service", "parent_duration_ms")


def audit_flat(spark, sf):
    flat = documents.flatten_audit(_docs(spark, sf, "audit_event", documents.AUDIT_DDL))
    return text_ts(flat, "ts").drop("target_type")


def audit_changes(spark, sf):
    changes = documents.explode_changes(_docs(spark, sf, "audit_event", documents.AUDIT_DDL))
    return changes.groupBy("field", "from_value", "to_value").agg(F.count(F.lit(1)).alias("n"))


# A fourth change, by event: its values before and after differ in type, and are nested at times.
_MIXED = """CASE n12 % 4 WHEN 0 THEN concat('{"field":"limit","from":', ms, ',"to":"none"}') WHEN 1 THEN '{"field":"limit","from":null,"to":2.5}'
  WHEN 2 THEN '{"field":"limit","from":{"daily":1,"tags":["a"]},"to":[1,2]}' ELSE '{"field":"limit","to":true}' END"""


def _mixed_changes(spark, sf):
    (facts,) = load(spark, sf, "line_facts")
    docs = rendered.messages(facts, "audit_event", "n3", "n12", "ms").withColumn("more", F.expr(_MIXED))
    return docs.select(F.when(F.col("n3") == 1, F.regexp_replace("message", r'"changes":\[', F.concat(F.lit('"changes":['), "more", F.lit(",")))).otherwise(F.col("message")).alias("message"))


_TYPED = [f"{end}_{part}" for end in ("from", "to") for part in ("type", "number", "text", "flag", "json")]


def audit_changes_typed(spark, sf):
    return documents.changes_typed(_mixed_changes(spark, sf)).groupBy("field", *_TYPED).agg(F.count(F.lit(1)).alias("n"))


def audit_change_schemas(spark, sf):
    return documents.change_schemas(_mixed_changes(spark, sf))


def label_counts(spark, sf):
    return documents.label_counts(_docs(spark, sf, "audit_event", documents.AUDIT_DDL))


def payment_rules(spark, sf):
    rules = documents.explode_rules(_docs(spark, sf, "payment_auth", documents.PAYMENT_DDL))
    out = documents.rule_stats(rules)
    return out.withColumns({c: F.round(c, 6) for c in ("mean_score", "max_score")})


def payment_flat(spark, sf):
    flat = documents.flatten_payment(_docs(spark, sf, "payment_auth", documents.PAYMENT_DDL))
    return flat.groupBy("channel", "decision", "brand", "trusted").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount"),
    )


def audit_payments(spark, sf):
    return audits.audit_payments(documents.flatten_payment(_docs(spark, sf, "payment_auth", documents.PAYMENT_DDL)))


def audit_spans(spark, sf):
    return audits.audit_spans(documents.flatten_span(_docs(spark, sf, "otel_span", documents.SPAN_DDL)))


_PAY_RULES = {
    "outcome": ("TRUE", "id % 89 = 0"),
    "posting": ("TRUE", "id % 73 = 0"),
    "reason_codes": ("TRUE", "n3 = 1 AND id % 79 = 0"),
    "risk_score": ("TRUE", "id % 83 = 0"),
    "tx_id": ("TRUE", "id % 97 = 0"),
    "journal_id": ("TRUE", "id % 101 = 0"),
}
_L = f"{LINES} AS f"

QUERIES: dict[str, tuple[Query, str | None]] = {
    "tx_rollup": (
        tx_rollup,
        f"""SELECT account_type, account_event, year, month, n, CAST(c AS DOUBLE) AS credit, CAST(d AS DOUBLE) AS debit,
  CAST(c - d AS DOUBLE) AS net FROM (
  SELECT account_type, account_event, year, month, count(*) AS n,
    sum(CASE WHEN event_type = 'credit' THEN {_cents("event_amount")} ELSE 0 END) AS c,
    sum(CASE WHEN event_type = 'debit' THEN {_cents("event_amount")} ELSE 0 END) AS d
  FROM {TX} AS t GROUP BY ALL) AS g""",
    ),
    "tx_pruned_month": (
        tx_pruned_month,
        f"""SELECT year, month, n, CAST(c AS DOUBLE) AS credit, CAST(d AS DOUBLE) AS debit, CAST(c - d AS DOUBLE) AS net
FROM (
  SELECT year, month, count(*) AS n, sum(CASE WHEN event_type = 'credit' THEN {_cents("event_amount")} ELSE 0 END) AS c,
    sum(CASE WHEN event_type = 'debit' THEN {_cents("event_amount")} ELSE 0 END) AS d
  FROM {TX} AS t WHERE timestamp BETWEEN TIMESTAMP '1997-11-01' AND TIMESTAMP '1998-02-15' GROUP BY ALL) AS g""",
    ),
    "tx_hours_band": (
        tx_hours_band,
        f"""SELECT CASE WHEN isodow(t) >= 6 THEN 'weekend' WHEN hour(t) >= 9 AND hour(t) < 18 THEN 'peak'
    WHEN hour(t) >= 7 AND hour(t) < 21 THEN 'shoulder' ELSE 'overnight' END AS band,
  hour(event_ts) BETWEEN 13 AND 23 AS business, count(*) AS n
FROM (SELECT event_ts, event_ts - INTERVAL 6 HOUR AS t FROM {LOGS} AS l) AS x GROUP BY ALL""",
    ),
    "dept_share": (
        dept_share,
        f"""SELECT department, n, round(share, 6) AS share, expected, abs(share - expected) <= 0.02 AS within FROM (
  SELECT department, count(*) AS n, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS share, {_MIX} AS expected
  FROM {STAFF} AS s GROUP BY department) AS g""",
    ),
    "subdept_share": (
        subdept_share,
        f"""SELECT department, sub_department, n, round(share, 6) AS share, abs(share - expected) <= 0.02 AS within FROM (
  SELECT department, sub_department, count(*) AS n,
    CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY department) AS share, {_SUB_MIX} AS expected
  FROM {STAFF} AS s GROUP BY department, sub_department) AS g""",
    ),
    "profile_tx": (
        profile_tx,
        f"""SELECT count(*) AS rows, CAST(26 AS BIGINT) AS columns, CAST(sum(length(account_event)) AS BIGINT) AS raw_bytes,
  {sql_ts("min(timestamp)")} AS first_ts, {sql_ts("max(timestamp)")} AS last_ts,
  count(DISTINCT accountID) AS accounts, count(DISTINCT account_event) AS events FROM {TX} AS t""",
    ),
    "audit_tx": (audit_tx, _rule_sql(TX, _TX_RULES)),
    "persona_profile": (
        persona_profile,
        f"""SELECT accountID IN ({_PERSONAS}) AS persona, count(*) AS n, count(DISTINCT accountID) AS accounts,
  max(event_amount) AS max_amount, count(*) FILTER (WHERE event_amount > 2500) AS above_2500
FROM {TX} AS t GROUP BY 1""",
    ),
    "audit_personas": (
        audit_personas,
        f"""WITH t AS (SELECT accountID, {_UNREMARKABLE} AS v FROM {TX} AS x), p AS (
  SELECT DISTINCT accountID FROM t WHERE accountID IN ({_PERSONAS})),
v AS (SELECT v, count(*) AS c FROM t GROUP BY v),
g AS (SELECT p.accountID, v.v, v.c AS c, count(t.v) AS own FROM p CROSS JOIN v LEFT JOIN t ON t.accountID = p.accountID AND t.v = v.v GROUP BY p.accountID, v.v, v.c),
r AS (SELECT accountID, sum(own) OVER w AS f, sum(c - own) OVER w AS h, sum(own) OVER a AS n, sum(c - own) OVER a AS rest FROM g
  WINDOW w AS (PARTITION BY accountID ORDER BY v), a AS (PARTITION BY accountID)),
d AS (SELECT accountID, n, rest, max(h / rest - f / n) AS above, max(f / n - h / rest) AS below FROM r GROUP BY ALL)
SELECT accountID, CAST(n AS BIGINT) AS n, round(greatest(above, 0.0), 9) AS above, round(greatest(below, 0.0), 9) AS below,
  round(sqrt(-ln(0.001) / 2 * (n + rest) / (n * rest)), 9) AS critical, above > sqrt(-ln(0.001) / 2 * (n + rest) / (n * rest)) AS remarkable FROM d""",
    ),
    "audit_roster": (audit_roster, _rule_sql(STAFF, _ROSTER_RULES)),
    "roster_range": (
        roster_range,
        f"""SELECT count(*) AS rows, count(DISTINCT c_custkey) AS addresses, 169803776 + min(c_custkey) AS low,
  169803776 + max(c_custkey) AS high, TRUE AS is_unique, max(c_custkey) - min(c_custkey) + 1 = count(*) AS is_contiguous
FROM {STAFF} AS s WHERE ip_address <> 'not-an-ip'""",
    ),
    "audit_orders": (audit_orders, _rule_sql(ORDERS, _ORDER_RULES)),
    "audit_orders_young": (audit_orders_young, _rule_sql(ORDERS, {**_ORDER_RULES, "status_by_age": ("TRUE", _TOO_EARLY)})),
    "order_revenue": (
        order_revenue,
        f"""SELECT country, category, tier, channel, CAST(year(placed) AS INTEGER) AS year, count(*) AS orders,
  CAST(sum({_cents(_USD)}) AS DOUBLE) AS revenue_usd,
  round(CAST(count(*) FILTER (WHERE status = 'returned') AS DOUBLE) / count(*), 6) AS return_rate,
  round(avg(CASE WHEN status = 'cancelled' THEN NULL WHEN k % 107 = 0 THEN -1 ELSE ship_days END), 6) AS delivery_days
FROM {ORDERS} AS o GROUP BY ALL""",
    ),
    "order_shipping": (
        order_shipping,
        f"""SELECT event, country, count(*) AS n, strftime(max(moment), '%Y-%m-%d') AS last_day FROM (
  SELECT 'label_created' AS event, wh_country AS country, placed + INTERVAL 1 DAY AS moment FROM {ORDERS} AS o
    WHERE status <> 'cancelled'
  UNION ALL SELECT 'delivered', country, placed + to_days(1 + ship_days) FROM {ORDERS} AS o WHERE status <> 'cancelled'
  UNION ALL SELECT NULL, NULL, NULL FROM {ORDERS} AS o WHERE status = 'cancelled') AS e GROUP BY event, country""",
    ),
    "order_tags": (
        order_tags,
        f"""SELECT tag, count(*) AS n FROM (
  SELECT unnest(CASE n_tags WHEN 0 THEN [] WHEN 1 THEN ['new'] ELSE ['eco', 'new'] END) AS tag FROM {ORDERS} AS o) AS t
GROUP BY tag""",
    ),
    "order_ndjson": (order_ndjson, f"SELECT tier, status, count(*) AS n FROM {ORDERS} AS o GROUP BY ALL"),
    "order_regions": (
        order_regions,
        f"""SELECT country, CASE WHEN country = 'Japan' THEN 'Tokyo' ELSE 'S1' END AS region, count(*) AS n
FROM {ORDERS} AS o GROUP BY ALL""",
    ),
    "season_factor": (
        season,
        f"""SELECT CAST(month AS INTEGER) AS month, n, round(n / avg(n) OVER (), 6) AS lift, CAST(CASE
    WHEN month IN (11, 12) THEN 1.9 WHEN month = 10 THEN 1.25 WHEN month IN (6, 7) THEN 0.85 ELSE 1.0 END AS DOUBLE)
  AS factor
FROM (SELECT month(placed) AS month, count(*) AS n FROM {ORDERS} AS o GROUP BY 1) AS m""",
    ),
    "results_json": (
        results_json,
        f"""SELECT CASE WHEN event_module IS NULL THEN '{{"n":' || count(*) || '}}'
  ELSE '{{"event_module":"' || event_module || '","n":' || count(*) || '}}' END AS result
FROM {LOGS} AS l GROUP BY event_module""",
    ),
    "span_flat": (
        span_flat,
        f"""SELECT id, svc AS service, '4.' || n12 || '.0' AS version, 'region-' || n3 AS region, 'pod-' || n12 AS pod,
  'trace' || id // 4 AS trace_id, 'span' || id AS span_id,
  CASE WHEN id % 4 <> 0 THEN 'span' || (id - id % 4) END AS parent_span_id, {sql_ts("ms_ts")} AS started_at,
  CAST(ms AS DOUBLE) AS duration_ms, CASE WHEN n3 = 0 THEN 'STATUS_CODE_ERROR' ELSE 'STATUS_CODE_OK' END AS status_code,
  status AS http_status, path AS route, ip AS client_ip, usr AS user_name, account AS account_id FROM {_L}""",
    ),
    "span_events": (
        span_events,
        f"""SELECT event, exception_type, count(*) AS n, CAST(sum(db_rows) AS BIGINT) AS db_rows, count(DISTINCT id) AS spans
FROM (SELECT 'db.query' AS event, NULL AS exception_type, n12 AS db_rows, id FROM {_L} WHERE n3 = 0
  UNION ALL SELECT 'exception', 'E' || n12, NULL, id FROM {_L} WHERE n3 = 0
  UNION ALL SELECT NULL, NULL, NULL, id FROM {_L} WHERE n3 <> 0) AS e GROUP BY event, exception_type""",
    ),
    "span_links": (
        span_links,
        f"""SELECT id, 'span' || id AS span_id, CASE WHEN n12 = 0 THEN 'trace' || id END AS link_trace_id,
  CASE WHEN n12 = 0 THEN 'span' || id END AS link_span_id FROM {_L}""",
    ),
    "span_tree": (
        span_tree,
        f"""SELECT c.id AS id, 'span' || c.id AS span_id, CASE WHEN c.id % 4 <> 0 THEN 'span' || (c.id - c.id % 4) END
    AS parent_span_id, p.svc AS parent_service, CAST(p.ms AS DOUBLE) AS parent_duration_ms
FROM {LINES} AS c LEFT JOIN {LINES} AS p ON c.id % 4 <> 0 AND p.id = c.id - c.id % 4""",
    ),
    "audit_flat": (
        audit_flat,
        f"""SELECT id, {sql_ts("ms_ts")} AS ts, event_type AS action,
  CASE WHEN n12 < 3 THEN 'denied' ELSE 'allowed' END AS outcome, CAST(n12 AS INTEGER) AS severity,
  CAST(n12 AS DOUBLE) / 20 AS risk_score, usr AS principal, n3 = 0 AS mfa_satisfied, ip AS source_ip,
  CASE WHEN n3 = 0 THEN 'US' ELSE 'RO' END AS country, CASE WHEN n3 = 0 THEN 'Denver' ELSE 'Cluj' END AS city,
  CAST(CASE WHEN n3 = 0 THEN 39.7392 ELSE 46.7712 END AS DOUBLE) AS lat,
  CAST(CASE WHEN n3 = 0 THEN -104.9903 ELSE 23.6236 END AS DOUBLE) AS lon,
  CAST(1000 + n12 AS INTEGER) AS asn, n12 = 5 AS vpn_detected, account AS account_id FROM {_L}""",
    ),
    "audit_changes": (
        audit_changes,
        f"""SELECT field, from_value, to_value, count(*) AS n FROM (
  SELECT unnest(['daily_limit', 'role', 'mfa_required']) AS field, unnest(['1000', 'viewer', 'true']) AS from_value,
    unnest(['5000', 'admin', 'false']) AS to_value FROM {_L} WHERE n3 = 1
  UNION ALL SELECT NULL, NULL, NULL FROM {_L} WHERE n3 <> 1) AS c GROUP BY ALL""",
    ),
    "audit_changes_typed": (
        audit_changes_typed,
        f"""SELECT field, from_type, from_number, from_text, from_flag, from_json, to_type, to_number, to_text, to_flag, to_json, count(*) AS n FROM (
  SELECT 'daily_limit' AS field, 'number' AS from_type, 1000::DOUBLE AS from_number, NULL AS from_text, NULL::BOOLEAN AS from_flag, NULL AS from_json,
    'number' AS to_type, 5000::DOUBLE AS to_number, NULL AS to_text, NULL::BOOLEAN AS to_flag, NULL AS to_json FROM {_L} WHERE n3 = 1
  UNION ALL SELECT 'role', 'text', NULL, 'viewer', NULL, NULL, 'text', NULL, 'admin', NULL, NULL FROM {_L} WHERE n3 = 1
  UNION ALL SELECT 'mfa_required', 'flag', NULL, NULL, TRUE, NULL, 'flag', NULL, NULL, FALSE, NULL FROM {_L} WHERE n3 = 1
  UNION ALL SELECT 'limit', CASE n12 % 4 WHEN 0 THEN 'number' WHEN 1 THEN 'null' WHEN 2 THEN 'object' END, CASE WHEN n12 % 4 = 0 THEN ms::DOUBLE END, NULL, NULL,
    CASE WHEN n12 % 4 = 2 THEN '{{"daily":1,"tags":["a"]}}' END, CASE n12 % 4 WHEN 0 THEN 'text' WHEN 1 THEN 'number' WHEN 2 THEN 'array' ELSE 'flag' END,
    CASE WHEN n12 % 4 = 1 THEN 2.5 END, CASE WHEN n12 % 4 = 0 THEN 'none' END, CASE WHEN n12 % 4 = 3 THEN TRUE END, CASE WHEN n12 % 4 = 2 THEN '[1,2]' END FROM {_L} WHERE n3 = 1
  UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM {_L} WHERE n3 <> 1) AS c GROUP BY ALL""",
    ),
    "audit_change_schemas": (
        audit_change_schemas,
        f"""SELECT field, count(*) AS n, any_value(a) AS from_schema, any_value(b) AS to_schema FROM (
  SELECT unnest(['daily_limit', 'role', 'mfa_required', 'limit']) AS field, unnest(['BIGINT', 'STRING', 'BOOLEAN', 'VARIANT']) AS a,
    unnest(['BIGINT', 'STRING', 'BOOLEAN', 'VARIANT']) AS b FROM {_L} WHERE n3 = 1) AS c GROUP BY field""",
    ),
    "label_counts": (
        label_counts,
        f"""SELECT label_kind, label, count(*) AS n FROM (
  SELECT 'role' AS label_kind, unnest(CASE WHEN n3 = 0 THEN ['viewer'] ELSE ['operator', 'viewer'] END) AS label FROM {_L}
  UNION ALL SELECT 'category', CASE WHEN n3 = 0 THEN 'iam' ELSE 'database' END FROM {_L}
  UNION ALL SELECT 'compliance', unnest(CASE WHEN n12 % 2 = 0 THEN ['sox', 'glba'] ELSE ['sox'] END) FROM {_L}) AS x
GROUP BY ALL""",
    ),
    "payment_rules": (
        payment_rules,
        f"""SELECT code, count(*) AS n, round(avg(score), 6) AS mean_score, round(max(score), 6) AS max_score,
  count(*) FILTER (WHERE action = 'monitor') AS n_monitor, count(*) FILTER (WHERE action = 'review') AS n_review,
  CAST(0 AS BIGINT) AS n_decline, CAST(0 AS BIGINT) AS n_challenge
FROM (SELECT 'R101' AS code, CAST(0.25 AS DOUBLE) AS score, 'monitor' AS action FROM {_L} WHERE n3 = 1
  UNION ALL SELECT 'R101', CAST(0.2 AS DOUBLE), 'review' FROM {_L} WHERE n3 = 2
  UNION ALL SELECT 'R204', CAST(0.5 AS DOUBLE), 'monitor' FROM {_L} WHERE n3 = 2) AS r GROUP BY code""",
    ),
    "payment_flat": (
        payment_flat,
        f"""SELECT event_type AS channel, CASE WHEN n12 < 9 THEN 'approved' ELSE 'declined' END AS decision,
  CASE WHEN n3 = 0 THEN 'visa' ELSE 'amex' END AS brand, n3 = 0 AS trusted, count(*) AS n,
  CAST(sum({_cents("value")}) AS DOUBLE) AS amount FROM {_L} GROUP BY ALL""",
    ),
    "audit_payments": (audit_payments, _rule_sql(LINES, _PAY_RULES)),
    "audit_spans": (
        audit_spans,
        _rule_sql(LINES, {"error_message": ("TRUE", "n3 = 0 AND id % 97 = 0"), "duration": ("TRUE", "FALSE")}),
    ),
}
