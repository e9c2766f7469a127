"""Roll-ups over transactions and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cents(value: str) -> Column:
    # Sums of doubles depend on the order of rows; decimals do not.
    return F.col(value).cast("decimal(18,2)")


def transaction_rollup(tx: DataFrame, *keys: str) -> DataFrame:
    """Debit, credit and net amount per group."""
    credit = F.sum(F.when(F.col("event_type") == "credit", _cents("event_amount")).otherwise(0))
    debit = F.sum(F.when(F.col("event_type") == "debit", _cents("event_amount")).otherwise(0))
    out = tx.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), credit.alias("credit"), debit.alias("debit"))
    return out.select(
        *keys, "n", F.col("credit").cast("double").alias("credit"), F.col("debit").cast("double").alias("debit"),
        (F.col("credit") - F.col("debit")).cast("double").alias("net"),
    )


def order_revenue(orders: DataFrame, *keys: str) -> DataFrame:
    """Orders, revenue in USD, return rate and mean delivery days per group."""
    delivery_days = F.datediff("delivered_at", "shipped_at")
    return orders.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(_cents("amount_usd")).cast("double").alias("revenue_usd"),
        F.round(F.count_if(F.col("status") == "returned") / F.count(F.lit(1)), 6).alias("return_rate"),
        F.round(F.avg(delivery_days), 6).alias("delivery_days"),
    )
