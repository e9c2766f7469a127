"""Nested JSON documents: spans, audit events, payment authorizations and orders, flattened and exploded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglattice.functions.fence import computed_once
from loglattice.operators.lookup import lookup_join

SPAN_DDL = """
resource STRUCT<attributes: STRUCT<`service.name`: STRING, `service.version`: STRING, `deployment.environment`: STRING,
  cloud: STRUCT<provider: STRING, region: STRING, availability_zone: STRING>,
  k8s: STRUCT<namespace: STRING, pod: STRUCT<name: STRING, uid: STRING>, node: STRUCT<name: STRING>>,
  host: STRUCT<name: STRING, arch: STRING>>>,
scope STRUCT<name: STRING, version: STRING>,
span STRUCT<traceId: STRING, spanId: STRING, parentSpanId: STRING, name: STRING, kind: STRING,
  startTimeUnixNano: BIGINT, endTimeUnixNano: BIGINT, status: STRUCT<code: STRING, message: STRING>,
  attributes: STRUCT<
    http: STRUCT<request: STRUCT<method: STRING, header: STRUCT<user_agent: STRING>>, response: STRUCT<status_code: INT>,
      route: STRING>,
    client: STRUCT<address: STRING, port: INT>, enduser: STRUCT<id: STRING, accountId: BIGINT>,
    net: STRUCT<peer: STRUCT<name: STRING>, protocol: STRUCT<name: STRING, version: STRING>>>,
  events: ARRAY<STRUCT<name: STRING, timeUnixNano: BIGINT, attributes: STRUCT<`db.system`: STRING, `db.statement`: STRING,
    `db.rows_affected`: INT, `exception.type`: STRING, `exception.message`: STRING, `exception.escaped`: BOOLEAN>>>,
  links: ARRAY<STRUCT<traceId: STRING, spanId: STRING, attributes: STRUCT<`link.type`: STRING>>>>
"""

# A change may go from a number, a text or a flag to another; as text fields both keep the scalar's own spelling.
AUDIT_DDL = """
`@timestamp` STRING,
event STRUCT<kind: STRING, category: ARRAY<STRING>, action: STRING, outcome: STRING, severity: INT, risk_score: DOUBLE>,
actor STRUCT<principal: STRUCT<id: STRING, name: STRING, type: STRING>,
  session: STRUCT<id: STRING, mfa: STRUCT<satisfied: BOOLEAN, method: STRING>>, roles: ARRAY<STRING>>,
source STRUCT<ip: STRING, port: INT, geo: STRUCT<country: STRING, city: STRING, lat: DOUBLE, lon: DOUBLE>,
  user_agent: STRUCT<original: STRING, device: STRUCT<name: STRING>>, network: STRUCT<asn: INT, vpn_detected: BOOLEAN>>,
target STRUCT<type: STRING, id: STRING, accountId: BIGINT, attributes: STRUCT<tier: STRING, region: STRING>>,
changes ARRAY<STRUCT<field: STRING, `from`: STRING, `to`: STRING>>, trace STRUCT<id: STRING, span: STRUCT<id: STRING>>,
labels STRUCT<env: STRING, compliance: ARRAY<STRING>>
"""

PAYMENT_DDL = """
`@timestamp` STRING, event STRUCT<dataset: STRING, type: ARRAY<STRING>, outcome: STRING>,
transaction STRUCT<id: STRING, accountId: BIGINT, amount: STRUCT<value: DOUBLE, currency: STRING>, channel: STRING,
  entry_mode: STRING, decision: STRING>,
card STRUCT<brand: STRING, last4: STRING, bin: STRUCT<number: STRING, country: STRING>,
  expiry: STRUCT<month: INT, year: INT>, token: STRUCT<id: STRING, provider: STRING>>,
merchant STRUCT<name: STRING, mcc: STRING, location: STRUCT<city: STRING, state: STRING, country: STRING>,
  acquirer: STRUCT<id: STRING, name: STRING>>,
device STRUCT<fingerprint: STRING, ip: STRING, geo: STRUCT<country: STRING, city: STRING, lat: DOUBLE, lon: DOUBLE>,
  trusted: BOOLEAN, attributes: STRUCT<os: STRING, rooted: BOOLEAN>>,
risk STRUCT<score: DOUBLE, model: STRUCT<name: STRING, version: STRING>,
  rules: ARRAY<STRUCT<code: STRING, name: STRING, score: DOUBLE, action: STRING>>, reason_codes: ARRAY<STRING>>,
ledger STRUCT<posting: STRUCT<status: STRING, journalId: STRING>>
"""

_REGIONS = "state: STRING, county: STRING, prefecture: STRING, province: STRING, region: STRING, district: STRING"
ORDER_DDL = f"""
order_id STRING, order_date STRING, status STRING, channel STRING, currency STRING, fx_rate_to_usd DOUBLE, quantity INT,
unit_price DOUBLE, subtotal DOUBLE, discount STRUCT<code: STRING, percent: INT, amount: DOUBLE>,
tax STRUCT<rate: DOUBLE, amount: DOUBLE>, total_amount DOUBLE, amount_usd DOUBLE,
customer STRUCT<id: STRING, name: STRUCT<first: STRING, last: STRING>, email: STRING, country: STRING, city: STRING,
  tier: STRING, segment: STRING, since: STRING,
  address: STRUCT<line1: STRING, city: STRING, {_REGIONS}, postal_code: STRING, country: STRING>,
  marketing_opt_in: BOOLEAN>,
product STRUCT<sku: STRING, name: STRING, category: STRING, subcategory: STRING, brand: STRING, list_price_usd: DOUBLE,
  attributes: STRUCT<color: STRING, size: STRING, weight_kg: DOUBLE, warranty_months: INT>,
  ratings: STRUCT<average: DOUBLE, count: INT>, tags: ARRAY<STRING>>,
shipping STRUCT<method: STRING, carrier: STRING, cost: DOUBLE, estimated_days: INT, tracking_number: STRING,
  shipped_at: STRING, delivered_at: STRING,
  destination: STRUCT<city: STRING, {_REGIONS}, postal_code: STRING, country: STRING>,
  events: ARRAY<STRUCT<status: STRING, at: STRING, location: STRUCT<city: STRING, country: STRING>>>>,
payment STRUCT<method: STRING, status: STRING, authorized_at: STRING,
  card: STRUCT<brand: STRING, last4: STRING, expiry: STRUCT<month: INT, year: INT>>, installments: INT>,
fulfillment STRUCT<warehouse: STRUCT<code: STRING, city: STRING, country: STRING>, cross_border: BOOLEAN,
  picked_at: STRING, packages: INT, gift_wrap: BOOLEAN>,
`return` STRUCT<requested_at: STRING, reason: STRING, condition: STRING,
  refund: STRUCT<amount: DOUBLE, currency: STRING, processed_at: STRING, restocking_fee: DOUBLE>, rma: STRING>
"""


def iso_ts(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX"))


def parsed(df: DataFrame, ddl: str, message: str = "message") -> DataFrame:
    """The input columns except the text, plus the parsed ``doc``.

    Text that does not start as a JSON object is left out; a broken object stays as a document of nulls.
    """
    objects = df.where(F.col(message).rlike(r"^\s*\{"))
    return computed_once(objects, {"doc": F.from_json(message, ddl)}).drop(message)


def _keep(df: DataFrame) -> list[Column]:
    return [F.col(c) for c in df.columns if c != "doc"]


def _region(place: Column) -> Column:
    """The regional division, whatever the country calls it."""
    return F.coalesce(*[place[n] for n in ("state", "county", "prefecture", "province", "region", "district")])


def flatten_span(docs: DataFrame) -> DataFrame:
    doc = F.col("doc")
    span, attrs = doc["span"], doc["resource"]["attributes"]
    http = span["attributes"]["http"]
    start = F.timestamp_micros(F.call_function("div", span["startTimeUnixNano"], F.lit(1000)))
    return docs.select(
        *_keep(docs),
        attrs["service.name"].alias("service"),
        attrs["service.version"].alias("version"),
        attrs["cloud"]["region"].alias("region"),
        attrs["k8s"]["pod"]["name"].alias("pod"),
        span["traceId"].alias("trace_id"),
        span["spanId"].alias("span_id"),
        span["parentSpanId"].alias("parent_span_id"),
        span["name"].alias("name"),
        start.alias("started_at"),
        ((span["endTimeUnixNano"] - span["startTimeUnixNano"]) / 1000000).alias("duration_ms"),
        span["status"]["code"].alias("status_code"),
        span["status"]["message"].alias("status_message"),
        http["response"]["status_code"].alias("http_status"),
        http["route"].alias("route"),
        span["attributes"]["client"]["address"].alias("client_ip"),
        span["attributes"]["enduser"]["id"].alias("user_name"),
        span["attributes"]["enduser"]["accountId"].alias("account_id"),
    )


def explode_events(docs: DataFrame) -> DataFrame:
    """One row per span event; a span without events keeps one row."""
    span = F.col("doc")["span"]
    out = docs.select(*_keep(docs), span["spanId"].alias("span_id"), F.posexplode_outer(span["events"]).alias("pos", "e"))
    attrs = F.col("e")["attributes"]
    return out.select(
        *_keep(docs), "span_id", "pos", F.col("e")["name"].alias("event"),
        attrs["db.statement"].alias("db_statement"), attrs["db.rows_affected"].alias("db_rows"),
        attrs["exception.type"].alias("exception_type"), attrs["exception.message"].alias("exception_message"),
    )


def explode_links(docs: DataFrame) -> DataFrame:
    """One row per span link; a span without links keeps one row."""
    span = F.col("doc")["span"]
    out = docs.select(*_keep(docs), span["spanId"].alias("span_id"), F.explode_outer(span["links"]).alias("l"))
    return out.select(
        *_keep(docs), "span_id", F.col("l")["traceId"].alias("link_trace_id"), F.col("l")["spanId"].alias("link_span_id")
    )


def span_tree(spans: DataFrame) -> DataFrame:
    """Every span with its parent's service and duration where the parent is present."""
    # Ids are unique by contract; a repeated span document must not multiply its children.
    parents = (
        spans.where(F.col("span_id").isNotNull())
        .groupBy("trace_id", F.col("span_id").alias("parent_span_id"))
        .agg(F.min("service").alias("parent_service"), F.max("duration_ms").alias("parent_duration_ms"))
    )
    # The parents grow with the spans, so they are never broadcast. Few spans have many children; adaptive execution splits those.
    return lookup_join(spans, parents, ["trace_id", "parent_span_id"], "left", fits=False, skewed=False).select(
        *spans.columns, "parent_service", "parent_duration_ms"
    )


def flatten_audit(docs: DataFrame) -> DataFrame:
    doc = F.col("doc")
    event, actor, source, target = doc["event"], doc["actor"], doc["source"], doc["target"]
    return docs.select(
        *_keep(docs),
        iso_ts(doc["@timestamp"]).alias("ts"),
        event["action"].alias("action"),
        event["outcome"].alias("outcome"),
        event["severity"].alias("severity"),
        event["risk_score"].alias("risk_score"),
        actor["principal"]["name"].alias("principal"),
        actor["session"]["mfa"]["satisfied"].alias("mfa_satisfied"),
        source["ip"].alias("source_ip"),
        source["geo"]["country"].alias("country"),
        source["geo"]["city"].alias("city"),
        source["geo"]["lat"].alias("lat"),
        source["geo"]["lon"].alias("lon"),
        source["network"]["asn"].alias("asn"),
        source["network"]["vpn_detected"].alias("vpn_detected"),
        target["type"].alias("target_type"),
        target["accountId"].alias("account_id"),
    )


_SHAPES = {"BIGINT": "number", "DOUBLE": "number", "FLOAT": "number", "DECIMAL": "number", "STRING": "text", "BOOLEAN": "flag", "OBJECT": "object", "ARRAY": "array"}


def change_values(df: DataFrame, message: str = "message") -> DataFrame:
    """One row per change with ``field`` and the VARIANT columns ``from`` and ``to``, whatever their types; an event without changes keeps one row.

    The input columns except the text are kept. Text that does not start as a JSON object is left out; a broken object has no changes.
    """
    objects = df.where(F.col(message).rlike(r"^\s*\{"))
    docs = computed_once(objects, {"found": F.try_variant_get(F.try_parse_json(message), "$.changes", "variant")}).drop(message)
    each = docs.sparkSession.sql("SELECT d.*, c.value FROM {docs} AS d, LATERAL variant_explode_outer(d.found) AS c", docs=docs)
    keep = [F.col(f"`{c}`") for c in docs.columns if c != "found"]
    ends = [F.try_variant_get("value", f"$.{end}", "variant").alias(end) for end in ("from", "to")]
    return each.select(*keep, F.try_variant_get("value", "$.field", "string").alias("field"), *ends)


def changes_typed(df: DataFrame, message: str = "message") -> DataFrame:
    """``change_values`` with each end as ``_type`` (number, text, flag, object, array, null) and ``_number``, ``_text``, ``_flag`` or ``_json``."""
    rows = change_values(df, message)
    out = [F.col(f"`{c}`") for c in rows.columns if c not in ("from", "to")]
    for end in ("from", "to"):
        schema = F.schema_of_variant(end)
        kind = F.lit("null")
        for name, shape in _SHAPES.items():
            kind = F.when(schema.startswith(name), shape).otherwise(kind)
        kind = F.when(F.col(end).isNotNull(), kind)
        out += [
            kind.alias(f"{end}_type"), F.when(kind == "number", F.try_variant_get(end, "$", "double")).alias(f"{end}_number"),
            F.when(kind == "text", F.try_variant_get(end, "$", "string")).alias(f"{end}_text"), F.when(kind == "flag", F.try_variant_get(end, "$", "boolean")).alias(f"{end}_flag"),
            F.when(kind.isin("object", "array"), F.to_json(end)).alias(f"{end}_json"),
        ]
    return rows.select(*out)


def change_schemas(df: DataFrame, message: str = "message") -> DataFrame:
    """Per field the types that its values before and after have anywhere, as one schema each: a drift shows as a wider or a variant type."""
    rows = change_values(df, message).where("field is not null")
    return rows.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.schema_of_variant_agg("from").alias("from_schema"), F.schema_of_variant_agg("to").alias("to_schema"))


def explode_changes(docs: DataFrame) -> DataFrame:
    """One row per changed field; an event without changes keeps one row."""
    out = docs.select(*_keep(docs), F.posexplode_outer(F.col("doc")["changes"]).alias("pos", "c"))
    c = F.col("c")
    return out.select(
        *_keep(docs), "pos", c["field"].alias("field"), c["from"].alias("from_value"), c["to"].alias("to_value")
    )


def label_counts(docs: DataFrame) -> DataFrame:
    """How many events carry each role, category and compliance label."""
    doc = F.col("doc")
    groups = F.array(
        *[
            F.struct(F.lit(name).alias("label_kind"), values.alias("labels"))
            for name, values in (
                ("role", doc["actor"]["roles"]),
                ("category", doc["event"]["category"]),
                ("compliance", doc["labels"]["compliance"]),
            )
        ]
    )
    return (
        docs.select(F.inline(groups))
        .select("label_kind", F.explode(F.array_distinct("labels")).alias("label"))
        .groupBy("label_kind", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def flatten_payment(docs: DataFrame) -> DataFrame:
    doc = F.col("doc")
    tx, card, merchant, device, risk = doc["transaction"], doc["card"], doc["merchant"], doc["device"], doc["risk"]
    return docs.select(
        *_keep(docs),
        iso_ts(doc["@timestamp"]).alias("ts"),
        doc["event"]["outcome"].alias("outcome"),
        tx["id"].alias("tx_id"),
        tx["accountId"].alias("account_id"),
        tx["amount"]["value"].alias("amount"),
        tx["channel"].alias("channel"),
        tx["entry_mode"].alias("entry_mode"),
        tx["decision"].alias("decision"),
        card["brand"].alias("brand"),
        card["bin"]["country"].alias("bin_country"),
        card["expiry"]["month"].alias("expiry_month"),
        card["expiry"]["year"].alias("expiry_year"),
        merchant["name"].alias("merchant"),
        merchant["mcc"].alias("mcc"),
        device["ip"].alias("device_ip"),
        device["trusted"].alias("trusted"),
        risk["score"].alias("risk_score"),
        risk["rules"].alias("rules"),
        risk["reason_codes"].alias("reason_codes"),
        doc["ledger"]["posting"]["status"].alias("posting_status"),
        doc["ledger"]["posting"]["journalId"].alias("journal_id"),
    )


def explode_rules(docs: DataFrame) -> DataFrame:
    """One row per fired rule; a payment without rules keeps one row."""
    out = docs.select(*_keep(docs), F.explode_outer(F.col("doc")["risk"]["rules"]).alias("r"))
    r = F.col("r")
    return out.select(*_keep(docs), *[r[n].alias(n) for n in ("code", "name", "score", "action")])


def rule_stats(rules: DataFrame) -> DataFrame:
    """Per rule code: firings, mean and highest score, and firings per action."""
    return (
        rules.where(F.col("code").isNotNull())
        .groupBy("code")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("score").alias("mean_score"),
            F.max("score").alias("max_score"),
            *[
                F.count_if(F.col("action") == a).alias(f"n_{a}")
                for a in ("monitor", "review", "decline", "challenge")
            ],
        )
    )


def flatten_order(docs: DataFrame) -> DataFrame:
    doc = F.col("doc")
    ship, pay, ful, ret = doc["shipping"], doc["payment"], doc["fulfillment"], doc["return"]
    return docs.select(
        *_keep(docs),
        *[
            doc[n].alias(n)
            for n in ("order_id", "status", "channel", "currency", "fx_rate_to_usd", "quantity", "unit_price", "subtotal",
                      "total_amount", "amount_usd")
        ],
        iso_ts(doc["order_date"]).alias("placed_at"),
        doc["discount"]["amount"].alias("discount_amount"),
        doc["tax"]["amount"].alias("tax_amount"),
        doc["customer"]["id"].alias("customer_id"),
        doc["customer"]["country"].alias("country"),
        doc["customer"]["city"].alias("city"),
        _region(doc["customer"]["address"]).alias("region"),
        doc["customer"]["tier"].alias("tier"),
        doc["product"]["name"].alias("product"),
        doc["product"]["category"].alias("category"),
        doc["product"]["tags"].alias("tags"),
        ship["method"].alias("ship_method"),
        ship["carrier"].alias("carrier"),
        ship["cost"].alias("ship_cost"),
        ship["estimated_days"].alias("estimated_days"),
        iso_ts(ship["shipped_at"]).alias("shipped_at"),
        iso_ts(ship["delivered_at"]).alias("delivered_at"),
        pay["method"].alias("pay_method"),
        pay["status"].alias("pay_status"),
        iso_ts(pay["authorized_at"]).alias("paid_at"),
        pay["card"].isNotNull().alias("has_card"),
        ful["warehouse"]["country"].alias("warehouse_country"),
        ful["cross_border"].alias("cross_border"),
        ret.isNotNull().alias("has_return"),
        ret["reason"].alias("return_reason"),
        ret["refund"]["amount"].alias("refund_amount"),
        ret["refund"]["restocking_fee"].alias("restocking_fee"),
        ret["rma"].alias("rma"),
    )


def explode_shipping(docs: DataFrame) -> DataFrame:
    """One row per carrier event; an order without events keeps one row."""
    doc = F.col("doc")
    out = docs.select(
        *_keep(docs), doc["order_id"].alias("order_id"), F.posexplode_outer(doc["shipping"]["events"]).alias("pos", "e")
    )
    e = F.col("e")
    return out.select(
        *_keep(docs), "order_id", "pos", e["status"].alias("event"), iso_ts(e["at"]).alias("at"),
        e["location"]["city"].alias("city"), e["location"]["country"].alias("country"),
    )


def tag_counts(orders: DataFrame) -> DataFrame:
    return orders.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
