import json
from datetime import datetime, timezone

from loglattice.plans import audits, documents

AS_OF = datetime(2024, 2, 1, tzinfo=timezone.utc)


def frame(spark, *docs):
    return spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "i int, message string")


def order(**changes):
    doc = {
        "order_id": "ORDER-00000001", "order_date": "2023-11-05T10:00:00.000Z", "status": "returned", "channel": "web",
        "currency": "EUR", "fx_rate_to_usd": 1.086957, "quantity": 2, "unit_price": 50.0, "subtotal": 100.0,
        "discount": {"code": "X", "percent": 10, "amount": 10.0}, "tax": {"rate": 0.1, "amount": 9.0}, "total_amount": 104.0,
        "amount_usd": 113.04,
        "customer": {"id": "CUST-1", "country": "Germany", "city": "Berlin", "address": {"state": "BE"}},
        "product": {"name": "Desk", "category": "Office", "tags": ["new", "eco"]},
        "shipping": {"carrier": "DHL", "cost": 5, "shipped_at": "2023-11-06T10:00:00.000Z",
                     "delivered_at": "2023-11-08T10:00:00.000Z",
                     "events": [{"status": "label_created", "at": "2023-11-06T10:00:00.000Z", "location": {"city": "B", "country": "G"}}]},
        "payment": {"method": "credit_card", "status": "refunded", "authorized_at": "2023-11-05T10:01:00.000Z", "card": {"brand": "visa"}},
        "fulfillment": {"warehouse": {"country": "United States"}, "cross_border": True},
        "return": {"reason": "x", "refund": {"amount": 104.0, "restocking_fee": 10.4}, "rma": "RMA-1234567"},
    }
    for path, value in changes.items():
        place, keys = doc, path.split("__")
        for k in keys[:-1]:
            place = place[k]
        place[keys[-1]] = value
    return doc


def broken(spark, doc):
    flat = documents.flatten_order(documents.parsed(frame(spark, doc), documents.ORDER_DDL))
    rows = audits.audit_orders(flat, AS_OF).collect()
    return {r.rule for r in rows if r.violations}


def test_clean_order_breaks_nothing(spark):
    assert broken(spark, order()) == set()


def test_damaged_orders(spark):
    assert broken(spark, order(tax__amount=10.0)) == {"total"}
    assert broken(spark, order(shipping__carrier="UPS")) == {"carrier_by_country"}
    assert broken(spark, order(amount_usd=200.0)) == {"usd"}
    assert broken(spark, order(shipping__delivered_at="2023-11-06T09:00:00.000Z")) == {"time_order"}
    assert broken(spark, order(payment__status="captured")) == {"payment_status"}
    assert broken(spark, order(payment__card=None)) == {"card_presence"}
    assert broken(spark, order(fulfillment__cross_border=False)) == {"cross_border"}
    assert broken(spark, order(**{"return__refund__restocking_fee": 5.0})) == {"restocking_fee"}
    assert broken(spark, order(status="shipped")) == {"payment_status", "return_after_delivery", "status_by_age"}
    assert broken(spark, order(order_id="ORDER-1")) == {"order_id"}


def test_short_form_and_region(spark):
    short = '{"order_id":"ORDER-001","total_amount":99.99,"customer":{"id":"CUST-1","country":"United States"},' \
            '"product":{"name":"Laptop Stand","category":"Electronics"}}'
    docs = documents.parsed(frame(spark, short, order(), "no json"), documents.ORDER_DDL)
    rows = {r.i: r for r in documents.flatten_order(docs).collect()}
    assert sorted(rows) == [0, 1]
    assert (rows[0].total_amount, rows[0].country, rows[0].category, rows[0].has_card) == (99.99, "United States", "Electronics", False)
    assert rows[1].region == "BE"
    assert {(r.i, r.event) for r in documents.explode_shipping(docs).collect()} == {(0, None), (1, "label_created")}
    assert {r.tag: r.n for r in documents.tag_counts(documents.flatten_order(docs)).collect()} == {"new": 1, "eco": 1}


def test_mixed_change_values_keep_their_text(spark):
    doc = {"actor": {"roles": ["a", "b"]}, "labels": {"compliance": ["sox"]}, "event": {"category": ["iam"]},
           "changes": [{"field": "l", "from": 1000, "to": 2000}, {"field": "r", "from": "viewer", "to": "x"},
                       {"field": "m", "from": True, "to": False}]}
    docs = documents.parsed(frame(spark, doc, {"changes": []}), documents.AUDIT_DDL)
    out = documents.explode_changes(docs).orderBy("i", "pos").collect()
    assert [r.from_value for r in out] == ["1000", "viewer", "true", None]
    labels = {(r.label_kind, r.label): r.n for r in documents.label_counts(docs).collect()}
    assert labels == {("role", "a"): 1, ("role", "b"): 1, ("category", "iam"): 1, ("compliance", "sox"): 1}


def test_pretty_span_and_tree(spark):
    def span(i, parent=None, code="STATUS_CODE_OK", message=""):
        return json.dumps({"resource": {"attributes": {"service.name": f"s{i}"}}, "span": {
            "traceId": "t", "spanId": f"p{i}", "parentSpanId": parent, "startTimeUnixNano": 1704449472345678901,
            "endTimeUnixNano": 1704449472345678901 + 5_000_000, "status": {"code": code, "message": message},
            "events": [{"name": "exception", "attributes": {"exception.type": "E"}}] if i else [], "links": []}}, indent=2)

    docs = documents.parsed(frame(spark, span(0), span(1, "p0", "STATUS_CODE_ERROR", "")), documents.SPAN_DDL)
    flat = documents.flatten_span(docs)
    tree = {r.span_id: r.parent_service for r in documents.span_tree(flat).collect()}
    assert tree == {"p0": None, "p1": "s0"}
    assert [r.duration_ms for r in flat.collect()] == [5.0, 5.0]
    assert {(r.span_id, r.exception_type) for r in documents.explode_events(docs).collect()} == {("p0", None), ("p1", "E")}
    assert {r.rule: r.violations for r in audits.audit_spans(flat).collect()} == {"error_message": 1, "duration": 0}


def test_payment_rules(spark):
    def pay(score, codes):
        rules = [{"code": "R1", "name": "a", "score": 0.2, "action": "review"}, {"code": "R2", "name": "b", "score": 0.5, "action": "monitor"}]
        return {"event": {"outcome": "failure"}, "transaction": {"id": "AUTH-0123456789AB", "decision": "declined"},
                "risk": {"score": score, "rules": rules, "reason_codes": codes}, "ledger": {"posting": {"status": "void", "journalId": "JRN-12345678"}}}

    docs = documents.parsed(frame(spark, pay(0.35, ["a", "b"]), pay(0.9, ["b", "a"])), documents.PAYMENT_DDL)
    found = {r.rule: r.violations for r in audits.audit_payments(documents.flatten_payment(docs)).collect()}
    assert found == {"outcome": 0, "posting": 0, "reason_codes": 1, "risk_score": 1, "tx_id": 0, "journal_id": 0}
    stats = {r.code: (r.n, r.mean_score, r.n_review) for r in documents.rule_stats(documents.explode_rules(docs)).collect()}
    assert stats == {"R1": (2, 0.2, 2), "R2": (2, 0.5, 0)}


def test_violating_rows_name_their_rules(spark):
    flat = documents.flatten_order(documents.parsed(frame(spark, order(), order(payment__card=None)), documents.ORDER_DDL))
    out = audits.violating_rows(flat, audits.order_rules(AS_OF)).collect()
    assert [(r.i, r.broken_rules) for r in out] == [(1, ["card_presence"])]
