"""Settings that every core query runs under."""

from loglattice.session import configure
from pyspark.sql import functions as F


def test_a_joined_task_takes_few_shuffled_bytes(spark):
    def parts():
        noise = [F.xxhash64("id", F.lit(i)).alias(f"x{i}") for i in range(4)]
        rows = spark.range(4_000_000).select("id", *noise).repartition("id")  # 130 MB that do not compress
        return len(rows.groupBy(F.spark_partition_id()).agg(*[F.max(f"x{i}") for i in range(4)]).collect())

    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    configure(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        assert parts() >= 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
