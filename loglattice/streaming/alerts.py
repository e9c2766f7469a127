"""Enrichment of alerts as they arrive, repeatable after a restart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loglattice.operators.enrich import DOC_KEY, enrich_alerts
from loglattice.session import BROADCAST_BYTES, fits_broadcast


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last version of every document; many copies of one document are reduced before the shuffle."""
    newest = F.struct(*order, F.xxhash64(*[c for c in df.columns if c not in key]))
    best = df.groupBy(*key).agg(F.max_by(F.struct(*df.columns), newest).alias("__row"))
    return best.select(*[F.col("__row")[c].alias(c) for c in df.columns])


def enrich_stream(
    stream: DataFrame,
    roster: DataFrame,
    sink: str,
    checkpoint: str,
    ts: str = "event_ts",
    doc_key: Sequence[str] = DOC_KEY,
    trigger: dict | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> StreamingQuery:
    """Every micro-batch is enriched from the roster and stored under its own ``batch_id`` folder.

    A batch repeated after a failure replaces its folder, so nothing is stored twice. ``read_enriched`` gives the last
    version of each alert over all batches.
    """
    # Chosen once, not per batch.
    strategy = "broadcast" if fits_broadcast(roster, max_bytes) else "join"

    def store(batch: DataFrame, batch_id: int) -> None:
        latest = latest_per_key(batch, doc_key, [ts])
        enriched = enrich_alerts(latest, roster, doc_key=doc_key, strategy=strategy)
        (
            enriched.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(sink)
        )

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_enriched(spark: SparkSession, sink: str, doc_key: Sequence[str] = DOC_KEY) -> DataFrame:
    """The last stored version of each alert."""
    stored = spark.read.parquet(sink)
    return latest_per_key(stored, doc_key, ["batch_id"]).drop("batch_id")


def enrich_refired(
    stream: DataFrame, roster: DataFrame, sink: str, checkpoint: str, ts: str = "event_ts", doc_key: Sequence[str] = DOC_KEY,
    buckets: int | None = None, within: str | None = None, trigger: dict | None = None, max_bytes: int = BROADCAST_BYTES,
) -> StreamingQuery:
    """As ``enrich_stream``, into a keyed store (``streaming.keyed``): a read costs one version per alert after any number of batches.

    ``within`` drops copies of an alert, equal in all columns, that arrive within this time of the first before they are enriched; alerts later
    than that by event time are then dropped as well. Whether the roster is broadcast is decided for every batch, as it may grow.
    """
    from loglattice.streaming import keyed

    if within is not None:
        stream = stream.withColumn("__copy", F.xxhash64(*stream.columns)).withWatermark(ts, within)
        stream = stream.dropDuplicatesWithinWatermark([*doc_key, "__copy"]).drop("__copy")

    def store(batch: DataFrame, batch_id: int) -> None:
        strategy = "broadcast" if fits_broadcast(roster, max_bytes) else "join"
        latest = latest_per_key(batch, doc_key, [ts])
        enriched = enrich_alerts(latest, roster, doc_key=doc_key, strategy=strategy)
        keyed.merge_batch(enriched, batch_id, sink, doc_key, [ts], buckets or keyed.BUCKETS)

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
