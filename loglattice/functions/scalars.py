"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Currencies without minor units, identifier shapes, season factors per month.
WHOLE_CURRENCIES = ("JPY", "KRW")
ID_SHAPES = {
    "order": "^ORDER-[0-9]{8,}$",
    "trade": "^TRD-[0-9]{12,}$",
    "customer": "^CUST-[0-9]+$",
    "rma": "^RMA-[0-9]{7,}$",
    "journal": "^JRN-[0-9]{8,}$",
    "authorization": "^AUTH-[0-9A-F]{12,}$",
}
SEASON_FACTORS = {11: 1.9, 12: 1.9, 10: 1.25, 6: 0.85, 7: 0.85}


def case(branches: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """First true branch wins; a null condition counts as false; no ``otherwise`` gives null."""
    out = F
    for condition, value in branches:
        out = out.when(condition, value)
    return out.otherwise(otherwise) if otherwise is not None else out


def distinct_values(value: Column | str) -> Column:
    """Aggregate: sorted distinct non-null values, null instead of an empty list."""
    found = F.collect_set(value)
    return F.when(F.size(found) > 0, F.array_sort(found))


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first last``; a missing part leaves the separating space in place."""
    first, last = (F.col(c) if isinstance(c, str) else c for c in (first, last))
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def iso_millis(ts: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSSZ`` in the session zone (UTC), milliseconds truncated."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def hour_band(ts: Column | str, zone: str = "America/Chicago") -> Column:
    """weekend / peak / shoulder / overnight, by local weekday and hour."""
    local = F.from_utc_timestamp(ts, zone)
    hour = F.hour(local)
    return case(
        [
            (F.weekday(local) >= 5, "weekend"),
            ((hour >= 9) & (hour < 18), "peak"),
            ((hour >= 7) & (hour < 21), "shoulder"),
        ],
        "overnight",
    )


def business_hour(ts: Column | str) -> Column:
    """UTC business-hours flag, 13:00 to 23:59."""
    return F.hour(ts).between(13, 23)


def season_factor(ts: Column | str) -> Column:
    month = F.month(ts)
    out = F
    for number, factor in SEASON_FACTORS.items():
        out = out.when(month == number, factor)
    return out.otherwise(1.0)


def money(value: Column, currency: Column) -> Column:
    """Round to the currency's minor unit."""
    return F.when(currency.isin(*WHOLE_CURRENCIES), F.bround(value, 0)).otherwise(F.bround(value, 2))


def money_tolerance(currency: Column) -> Column:
    """One last unit, since every stored part is rounded on its own."""
    return F.when(currency.isin(*WHOLE_CURRENCIES), F.lit(1.0)).otherwise(F.lit(0.011))


def to_usd(total: Column, fx_to_usd: Column) -> Column:
    """Convert with the document's own rate (USD per unit)."""
    return F.round(total * fx_to_usd, 2)


def id_ok(value: Column | str, shape: str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return value.rlike(ID_SHAPES[shape])


def parse_id_list(value: Column | str) -> Column:
    """Comma-separated text as an array of trimmed, non-empty ids."""
    parts = F.transform(F.split(value, ","), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def mean_score(items: Column, field: str) -> Column:
    """Mean of a number over an array of structs, 0 when empty, 3 decimals."""
    total = F.aggregate(items, F.lit(0.0), lambda acc, item: acc + item[field])
    return F.round(total / F.greatest(F.lit(1), F.size(items)), 3)


def replace_pattern(value: Column | str, pattern: str, replacement: str, flags: str = "") -> Column:
    """Regex replace with optional ``i`` and ``m`` flags, look-ahead and ``$1`` references."""
    return F.regexp_replace(value, f"(?{flags}){pattern}" if flags else pattern, replacement)
