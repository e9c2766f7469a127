"""Archive tables laid out for look-ups by account: partitioned by year, bucketed and sorted by account."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglattice.session import fits_broadcast

BUCKETS = 32


def store_archive(tx: DataFrame, path: str, buckets: int = BUCKETS, account: str = "accountID", year: str = "year") -> str:
    """Write ``tx`` as an external table under ``path`` and give its name; one shuffle, and one file per year and bucket.

    Joins and groupings by account then read the buckets as they are, and a join on the year reads the years that the other side names.
    """
    name = f"archive_{uuid.uuid4().hex}"
    writer = tx.repartition(buckets, account).write.partitionBy(year).bucketBy(buckets, account).sortBy(account)
    writer.option("path", path).format("parquet").mode("overwrite").saveAsTable(name)
    return name


def recent_accounts(archive: DataFrame, recent: DataFrame, years_back: int = 2, account: str = "accountID", year: str = "year", amount: str = "event_amount") -> DataFrame:
    """Accounts of ``recent`` beside their archive rows of the ``years_back`` years before their first recent one.

    The (account, year) pairs asked for are broadcast if their measured size allows it: the archive is then neither shuffled nor read beyond those
    years. Otherwise they are shuffled to its buckets. Rows with a null account belong to nobody.
    """
    now = recent.where(F.col(account).isNotNull()).groupBy(account).agg(F.count(F.lit(1)).alias("recent_n"), F.min(year).alias("first_year"))
    asked = now.select(account, "recent_n", F.explode(F.sequence(F.col("first_year") - years_back, F.col("first_year") - 1)).alias(year))
    asked = F.broadcast(asked) if fits_broadcast(asked) else asked
    return archive.join(asked, [account, year]).groupBy(account).agg(
        F.max("recent_n").alias("recent_n"), F.count(F.lit(1)).alias("archive_n"), F.max(year).alias("last_year"),
        F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias("archive_amount"),
    )


def drop_archive(spark: SparkSession, name: str) -> None:
    """Forget the table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
