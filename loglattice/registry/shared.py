"""Helpers for the registered queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglattice.functions.ip import IPV4
from loglattice.registry import derived

Query = Callable[[SparkSession, str], DataFrame]

IP_RE = IPV4
#: The reference point in time of every relative rule; the events end in January 2024.
AS_OF = datetime(2024, 2, 1, tzinfo=timezone.utc)

LOGS, HR, ALERTS, TX, ORDERS, LINES = (
    derived.sql(n) for n in ("logs", "hr", "alerts", "transactions", "order_facts", "line_facts")
)


def load(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [derived.frame(spark, sf_dir, n) for n in names]


def joined(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """List columns as ``|``-joined text."""
    return df.withColumns({c: F.array_join(c, "|") for c in columns})


def text_ts(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text with milliseconds."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS") for c in columns})


def sql_ts(expression: str) -> str:
    """The same text form in the checking SQL."""
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%g')"


def valid_ip(column: str) -> str:
    return f"CASE WHEN regexp_matches({column}, '{IP_RE}') THEN {column} END"


def listed(column: str, name: str) -> str:
    return f"string_agg(DISTINCT {column}, '|' ORDER BY {column}) AS {name}"
