"""Compute costly columns exactly once per row.

The optimizer moves a filter below the projection that computes the filtered column and repeats the expression there.
For a regex or JSON parse that doubles the work, and over a chain of projections the copied expression grows without
bound. Passing the columns through a one-element ``explode`` stops this: filters on generated columns stay above.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``df`` plus ``columns``, each evaluated once whatever filters and projections follow."""
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.explode(F.array(row)).alias("__once")).select(
        *kept, *[F.col("__once")[name].alias(name) for name in columns]
    )
