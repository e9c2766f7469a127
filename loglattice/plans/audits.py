"""Business rules checked over finished tables.

A rule is a named condition for a violation, null when the rule does not apply. Each audit reads its table once and
gives one row per rule with ``checked`` and ``violations``; ``violating_rows`` gives the rows themselves.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglattice.functions.ip import ip_to_long
from loglattice.functions.scalars import id_ok, iso_millis, mean_score, money_tolerance
from loglattice.operators.quantiles import distance_from_rest

# Country, currency, carriers and cities of the 13 markets.
MARKETS = [
    ("United States", "USD", ["UPS", "FedEx", "USPS"],
     ["Austin", "Pittsburgh", "Denver", "Seattle", "Chicago", "Miami"]),
    ("Germany", "EUR", ["DHL", "Hermes", "DPD"], ["Berlin", "Munich", "Hamburg", "Cologne"]),
    ("United Kingdom", "GBP", ["Royal Mail", "DPD", "Evri"], ["London", "Manchester", "Bristol", "Edinburgh"]),
    ("Japan", "JPY", ["Yamato", "Sagawa", "Japan Post"], ["Tokyo", "Osaka", "Nagoya", "Fukuoka"]),
    ("Canada", "CAD", ["Canada Post", "Purolator", "UPS"], ["Toronto", "Vancouver", "Montreal", "Calgary"]),
    ("France", "EUR", ["Colissimo", "Chronopost", "DPD"], ["Paris", "Lyon", "Marseille"]),
    ("Australia", "AUD", ["Australia Post", "StarTrack", "Aramex"], ["Sydney", "Melbourne", "Brisbane", "Perth"]),
    ("Netherlands", "EUR", ["PostNL", "DHL", "DPD"], ["Amsterdam", "Rotterdam", "Utrecht"]),
    ("Brazil", "BRL", ["Correios", "Jadlog", "Loggi"], ["Sao Paulo", "Rio de Janeiro", "Belo Horizonte"]),
    ("India", "INR", ["Delhivery", "Blue Dart", "India Post"], ["Bengaluru", "Mumbai", "Delhi", "Hyderabad"]),
    ("Sweden", "SEK", ["PostNord", "DHL", "Budbee"], ["Stockholm", "Gothenburg"]),
    ("Singapore", "SGD", ["SingPost", "Ninja Van", "DHL"], ["Singapore"]),
    ("Mexico", "MXN", ["Estafeta", "DHL", "FedEx"], ["Mexico City", "Guadalajara", "Monterrey"]),
]
# The direction of each account event (None: either) and the columns only some events may fill.
EVENT_DIRECTION = {
    "purchase": "debit", "withdrawal": "debit", "wire": None, "fee": "debit", "deposit": "credit",
    "inquiry": "debit", "status_check": "debit",
    "buy": "debit", "sell": "credit", "dividend": "credit", "transfer": None, "liquidation": "credit",
}
FILLED_ONLY_BY = {
    "posID": ("purchase",),
    "deposit_type": ("deposit",),
    "txbankId": ("wire",),
    "wire_direction": ("wire", "transfer"),
    "intbankID": ("wire", "transfer"),
    "to_account": ("wire",),
    "security_symbol": ("buy", "sell", "dividend", "liquidation"),
    "tradeID": ("buy", "sell", "liquidation"),
}
# Accounts whose history is kept unremarkable.
PERSONA_ACCOUNTS = [
    2, 4, 6, 8, 10, 12, 14, 16, 18, 20,
    32687, 16384, 8192, 4096, 2048, 1594, 21162, 1874, 2718, 3141, 1618, 1414,
]
# Department shares in percent and sub-department weights.
DEPARTMENT_MIX = {
    "sales": 35, "engineering": 20, "marketing": 15, "support": 15, "finance": 8, "legal": 4, "leadership": 3,
}
SUB_DEPARTMENT_MIX = {
    "legal": {"compliance": 1, "vendor-relations": 1, "customer-relations": 1},
    "finance": {"order-ops": 1, "comptroller": 1, "commission-management": 1},
    "marketing": {"webinars": 1, "trade-shows": 1, "commercials": 1},
    "sales": {"account_executive": 100, "solution_architect": 100, "sdr": 100, "ae_manager": 5, "sa_manager": 5,
              "sdr_manager": 3},
    "support": {"support_engineer": 80, "escalation_manager": 15, "support_manager": 5},
    "engineering": {"engineer": 85, "product_manager": 10, "director": 5},
    "leadership": {"executive": 40, "chief_of_staff": 25, "board_relations": 20, "corp_dev": 15},
}
HIRE_WINDOW = ("2012-03-15", "2026-03-15")


def violations_by_rule(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule: rows it applies to and rows that break it."""
    found = df.agg(
        *[F.count(broken).alias(f"{name}__checked") for name, broken in rules.items()],
        *[F.count_if(F.coalesce(broken, F.lit(False))).alias(f"{name}__broken") for name, broken in rules.items()],
    )
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"{name}__checked").alias("checked"),
            F.col(f"{name}__broken").alias("violations"),
        )
        for name in rules
    ]
    return found.select(F.inline(F.array(*rows)))


def violating_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break any rule, with the names of the broken rules."""
    names = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
    return df.withColumn("broken_rules", names).where(F.size("broken_rules") > 0)


def _differs(a: Column, b: Column, tolerance: Column | float) -> Column:
    return F.abs(a - b) > (F.lit(tolerance) if isinstance(tolerance, float) else tolerance)


def _by_country(position: int) -> Column:
    out = F
    for market in MARKETS:
        value = market[position]
        out = out.when(
            F.col("country") == market[0], F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value)
        )
    return out.otherwise(None)


def order_rules(as_of: datetime) -> dict[str, Column]:
    """Rules over flattened orders."""
    c = F.col
    cents = money_tolerance(c("currency"))
    age_days = F.floor((F.lit(as_of).cast("timestamp").cast("double") - c("placed_at").cast("double")) / 86400)
    allowed = (
        F.when(age_days < 1, F.array(F.lit("pending"), F.lit("processing")))
        .when(age_days < 3, F.array(F.lit("processing"), F.lit("shipped"), F.lit("cancelled")))
        .when(age_days < 10, F.array(F.lit("shipped"), F.lit("delivered"), F.lit("cancelled")))
        .otherwise(F.array(F.lit("delivered"), F.lit("returned"), F.lit("cancelled")))
    )
    expected_pay = (
        F.when(c("status") == "returned", "refunded").when(c("status") == "cancelled", "voided").otherwise("captured")
    )
    out_of_order = (
        F.coalesce(c("paid_at") < c("placed_at"), F.lit(False))
        | F.coalesce(c("shipped_at") < c("placed_at"), F.lit(False))
        | F.coalesce(c("shipped_at") < c("paid_at"), F.lit(False))
        | F.coalesce(c("delivered_at") < c("shipped_at"), F.lit(False))
        | F.coalesce(c("delivered_at") < c("placed_at"), F.lit(False))
    )
    usd = c("total_amount") * c("fx_rate_to_usd")
    fee = c("restocking_fee")
    return {
        "total": _differs(
            c("total_amount"), c("subtotal") - c("discount_amount") + c("tax_amount") + c("ship_cost"), cents
        ),
        "currency_by_country": c("currency") != _by_country(1),
        "carrier_by_country": ~F.array_contains(_by_country(2), c("carrier")),
        "city_by_country": ~F.array_contains(_by_country(3), c("city")),
        "usd": _differs(c("amount_usd"), usd, F.lit(0.01) + F.abs(usd) * 0.0001),
        "whole_currency": F.when(c("currency").isin("JPY", "KRW"), c("total_amount") != F.round(c("total_amount"))),
        "time_order": out_of_order,
        "return_after_delivery": F.when(c("has_return"), c("delivered_at").isNull() | (c("status") != "returned")),
        "status_by_age": ~F.array_contains(allowed, c("status")),
        "payment_status": c("pay_status") != expected_pay,
        "card_presence": c("has_card") != c("pay_method").isin("credit_card", "debit_card"),
        "cross_border": c("cross_border") != (c("warehouse_country") != c("country")),
        "refund_amount": F.when(c("has_return"), _differs(c("refund_amount"), c("total_amount"), 0.001)),
        "restocking_fee": F.when(
            c("has_return"), (fee != 0) & _differs(fee, c("total_amount") / 10, cents)
        ),
        "order_id": ~id_ok("order_id", "order"),
        "customer_id": ~id_ok("customer_id", "customer"),
        "rma": F.when(c("has_return"), ~id_ok("rma", "rma")),
    }


def audit_orders(orders: DataFrame, as_of: datetime) -> DataFrame:
    return violations_by_rule(orders, order_rules(as_of))


def seasonal_lift(orders: DataFrame) -> DataFrame:
    """Orders per month and their ratio to the mean month."""
    counts = orders.groupBy(F.month("placed_at").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("lift", F.col("n") / counts.agg(F.avg("n")).scalar())


def transaction_rules() -> dict[str, Column]:
    """Rules over transactions."""
    c = F.col
    event = c("account_event")
    direction = F
    for name, side in EVENT_DIRECTION.items():
        if side:
            direction = direction.when(event == name, F.lit(side))
    traded = c("security_symbol").isNotNull() & (event != "dividend")
    rules = {
        "trade_quantity": F.when(
            c("quantity").isNotNull() & (c("price_per_unit") > 0),
            _differs(c("quantity"), F.round(c("event_amount") / c("price_per_unit"), 4), 0.00011),
        ),
        "trade_fields": (traded != c("tradeID").isNotNull()) | (traded != c("counterparty_account").isNotNull()),
        "trade_id": F.when(
            c("tradeID").isNotNull(),
            ~id_ok("tradeID", "trade")
            | (F.substring("tradeID", 5, 4) != F.year("timestamp").cast("string")),
        ),
        "direction": c("event_type") != direction.otherwise(c("event_type")),
        "zero_inquiry": F.when(event.isin("inquiry", "status_check"), c("event_amount") != 0),
        "address": F.when(c("accountID") <= 35000, ~c("addressId").eqNullSafe(c("accountID"))),
        "date_text": c("transaction_date") != iso_millis("timestamp"),
        "settlement": (traded != c("settlement_date").isNotNull())
        | F.coalesce(~F.datediff(F.try_to_date("settlement_date", "yyyy-MM-dd"), F.to_date("timestamp")).isin(1, 2), c("settlement_date").isNotNull()),
        "partition": (c("year") != F.year("timestamp")) | (c("month") != F.month("timestamp")),
        "known_event": ~event.isin(*EVENT_DIRECTION),
    }
    for name, events in FILLED_ONLY_BY.items():
        rules[f"only_{name}"] = F.when(c(name).isNotNull(), ~event.isin(*events))
    return rules


def audit_transactions(tx: DataFrame) -> DataFrame:
    return violations_by_rule(tx, transaction_rules())


def persona_profile(tx: DataFrame) -> DataFrame:
    """Amount statistics of the persona accounts beside all other accounts."""
    persona = F.col("accountID").isin(*PERSONA_ACCOUNTS)
    return tx.groupBy(persona.alias("persona")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("accountID").alias("accounts"),
        F.max("event_amount").alias("max_amount"),
        F.count_if(F.col("event_amount") > 2500).alias("above_2500"),
    )


def audit_personas(tx: DataFrame, significance: float = 0.001) -> DataFrame:
    """Per persona account whether its history is unremarkable: its amounts must not lie above those of all other accounts.

    The one-sided Kolmogorov-Smirnov distance is compared with its critical value at ``significance``. Accounts without amounts have no row.
    """
    found = distance_from_rest(tx, "accountID", "event_amount", F.col("accountID").isin(*PERSONA_ACCOUNTS))
    critical = F.sqrt(F.lit(-math.log(significance) / 2) * (F.col("n") + F.col("rest")) / (F.col("n") * F.col("rest")))
    out = found.select("accountID", "n", "above", "below", critical.alias("critical"))
    return out.withColumn("remarkable", F.col("above") > F.col("critical"))


def roster_rules() -> dict[str, Column]:
    hired = F.try_to_date("start_date", "yyyy-MM-dd")
    known = F.col("department").isin(*DEPARTMENT_MIX)
    subs = F
    for department, mix in SUB_DEPARTMENT_MIX.items():
        subs = subs.when(F.col("department") == department, F.col("sub_department").isin(*mix))
    return {
        "valid_ip": ip_to_long("ip_address").isNull(),
        "hire_window": hired.isNull() | ~hired.between(*[F.to_date(F.lit(d)) for d in HIRE_WINDOW]),
        "department": ~known,
        "sub_department": ~subs,
    }


def audit_roster(roster: DataFrame) -> DataFrame:
    return violations_by_rule(roster, roster_rules())


def roster_range(roster: DataFrame) -> DataFrame:
    """One row: whether the valid addresses are unique and form one unbroken range."""
    number = ip_to_long("ip_address")
    found = roster.select(number.alias("n")).where(F.col("n").isNotNull()).groupBy("n").agg(F.count("n").alias("rows"))
    out = found.agg(
        F.sum("rows").alias("rows"), F.count("n").alias("addresses"), F.min("n").alias("low"), F.max("n").alias("high")
    )
    return out.select(
        "rows", "addresses", "low", "high",
        (F.col("rows") == F.col("addresses")).alias("is_unique"),
        (F.col("high") - F.col("low") + 1 == F.col("addresses")).alias("is_contiguous"),
    )


def department_mix(roster: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Department shares against the stated mix."""
    from loglattice.operators.shares import share_of_total

    expected = F
    for name, pct in DEPARTMENT_MIX.items():
        expected = expected.when(F.col("department") == name, F.lit(pct / 100))
    shares = share_of_total(roster, "department").withColumn("expected", expected.otherwise(None))
    return shares.withColumn("within", F.abs(F.col("share") - F.col("expected")) <= tolerance)


def sub_department_mix(roster: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Sub-department shares within their department against the stated weights."""
    from loglattice.operators.shares import share_in_parent

    expected = F
    for department, mix in SUB_DEPARTMENT_MIX.items():
        total = sum(mix.values())
        for name, weight in mix.items():
            same = (F.col("department") == department) & (F.col("sub_department") == name)
            expected = expected.when(same, F.lit(weight / total))
    shares = share_in_parent(roster, "department", "sub_department").withColumn("expected", expected.otherwise(None))
    return shares.withColumn("within", F.abs(F.col("share") - F.col("expected")) <= tolerance)


def payment_rules() -> dict[str, Column]:
    """Rules over flattened payments."""
    c = F.col
    approved = c("decision") == "approved"
    return {
        "outcome": c("outcome") != F.when(approved, "success").otherwise("failure"),
        "posting": c("posting_status") != F.when(approved, "pending").otherwise("void"),
        "reason_codes": ~c("reason_codes").eqNullSafe(F.transform("rules", lambda r: r["name"])),
        "risk_score": _differs(c("risk_score"), mean_score(c("rules"), "score"), 0.0011),
        "tx_id": ~id_ok("tx_id", "authorization"),
        "journal_id": ~id_ok("journal_id", "journal"),
    }


def audit_payments(payments: DataFrame) -> DataFrame:
    return violations_by_rule(payments, payment_rules())


def span_rules() -> dict[str, Column]:
    """Rules over flattened spans."""
    error = F.col("status_code") == "STATUS_CODE_ERROR"
    return {
        "error_message": error != (F.col("status_message") == "handler threw"),
        "duration": F.col("duration_ms") < 0,
    }


def audit_spans(spans: DataFrame) -> DataFrame:
    return violations_by_rule(spans, span_rules())
