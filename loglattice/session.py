"""Session settings, scratch folders and the size check that guards every broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table, in bytes of text, that an operator may broadcast.
BROADCAST_BYTES = 256 * 1024 * 1024

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffled bytes are compressed: keys in sequence take up to ten times as much in the sorts of a join.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # HotSpot does not compile methods beyond this size; larger stages are generated in smaller pieces instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Sessions are merged before the shuffle, so a busy key arrives as a few sessions.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the library relies on."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = 8, app: str = "loglattice", memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="loglattice-")
    return os.path.join(shared, f"{purpose}-{uuid.uuid4().hex}")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once under the shared folder and read back: for what is used several times, or must not be numbered twice."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` with one distributed aggregate and compare it with the broadcast limit."""
    widths = [
        F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + F.lit(16) for c in df.columns
    ]
    size = df.agg(F.sum(reduce(lambda a, b: a + b, widths)).alias("size")).first()["size"]
    return (size or 0) <= max_bytes


#: Largest scan, in bytes by its own statistics, that ``spread`` deals out again.
SPREAD_BYTES = 256 * 1024 * 1024


def spread(df: DataFrame) -> DataFrame:
    """Rows of a small scan over all cores, for work that is costly per row on an input too small to be split by size.

    A larger scan has splits of its own and is never shuffled.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if int(size) <= SPREAD_BYTES else df
