"""A keyed store for documents that arrive again: one row per key, whatever the number of batches.

Rows lie in hash buckets. A batch reads the buckets that it touches, merges its rows into them and writes each to the slot that is not in use;
a table of one row per bucket then names the slots in use as of this batch. So a reader opens one version of every bucket, storage holds two at
most, and a batch that runs again starts from the same slots and writes the same rows. A reader still at work two batches later may find its
files replaced and has to read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglattice.sources import files
from loglattice.streaming.alerts import latest_per_key

BUCKETS = 64
_SLOTS = "bucket INT, in_slot INT, batch_id BIGINT, turn INT"


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _slots(spark: SparkSession, sink: str, before: int | None = None) -> dict[int, int]:
    """Bucket to slot after the last batch, or the last one before ``before``; one row per bucket."""
    try:
        rows = spark.read.schema(_SLOTS).parquet(f"{sink}/slots")
        rows = (rows if before is None else rows.where(F.col("batch_id") < before)).collect()
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        rows = []
    last = max((r["batch_id"] for r in rows), default=None)
    return {r["bucket"]: r["in_slot"] for r in rows if r["batch_id"] == last}


def _in_use(slots: dict[int, int]) -> Column:
    """The partitions named by ``slots``, as literals, so that no other folder is opened."""
    out = F.lit(False)
    for slot in (0, 1):
        buckets = [b for b, s in slots.items() if s == slot]
        if buckets:
            out = out | ((F.col("slot") == slot) & F.col("bucket").isin(buckets))
    return out


def _data(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, slot INT, bucket INT").parquet(f"{sink}/data")


def merge_batch(batch: DataFrame, batch_id: int, sink: str, key: Sequence[str], order: Sequence[str], buckets: int = BUCKETS) -> None:
    """Merge the last version of every document of ``batch`` into the store; documents of later batches replace those of earlier ones.

    Documents with null keys are one document. ``buckets`` must not change during the life of a store.
    """
    spark = batch.sparkSession
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields)
    fresh = latest_per_key(batch, key, order).withColumn("bucket", bucket_of(key, buckets)).withColumn("__fresh", F.lit(1))
    fresh = fresh.persist()
    try:
        touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        slots = _slots(spark, sink, batch_id)
        known = {b: slots[b] for b in touched if b in slots}
        rows = fresh
        if known:
            rows = rows.unionByName(_data(spark, sink, schema).where(_in_use(known)).drop("slot").withColumn("__fresh", F.lit(0)))
        merged = latest_per_key(rows, [*key, "bucket"], ["__fresh"]).drop("__fresh")
        free = F.lit(0)
        if any(s == 0 for s in known.values()):
            free = F.when(F.col("bucket").isin([b for b, s in known.items() if s == 0]), 1).otherwise(0)
        if touched:
            files.write_partitions(merged.withColumn("slot", free), f"{sink}/data", ["slot", "bucket"])
        now = slots | {b: 1 - known.get(b, 1) for b in touched}
        table = spark.createDataFrame([(b, s, batch_id, batch_id % 2) for b, s in now.items()], _SLOTS)
        files.write_partitions(table.coalesce(1), f"{sink}/slots", ["turn"], cluster=False)
    finally:
        fresh.unpersist()


def read_store(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    """The stored documents, one row per key; no shuffle, and one version of each bucket is opened."""
    return _data(spark, sink, schema).where(_in_use(_slots(spark, sink))).drop("slot", "bucket")
