"""Sources: ids for files that bring none and know no row positions, and the archive laid out by account."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglattice.registry.shared import LOGS, TX, Query, load
from loglattice.session import scratch_dir
from loglattice.sources import archive, files

_SPLIT = "spark.sql.files.maxPartitionBytes"
_LEAST_SPLIT = 16 * 1024


def _reread(spark, read, folder):
    """The ids of the same files, read with splits of another size, stored."""
    size = read().select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0] or 0
    before = spark.conf.get(_SPLIT)
    spark.conf.set(_SPLIT, str(max(_LEAST_SPLIT, size // 64)))
    try:
        files.with_ids(read(), "other").select("event_id", F.col("_id").alias("again")).write.parquet(folder)
    finally:
        spark.conf.set(_SPLIT, before)
    return spark.read.schema("event_id long, again string").parquet(folder)


def _ids_from(fmt):
    """Log documents without ids, written in order; ids and positions from the files, and whether ids are unique and the same on another read."""

    def run(spark, sf):
        (logs,) = load(spark, sf, "logs")
        folder = scratch_dir(spark, f"logs-{fmt}")
        rows = logs.select(F.col("_id").cast("long").alias("event_id"), "event_module", "client_ip")
        rows = rows.repartitionByRange("event_id").sortWithinPartitions("event_id")
        if fmt == "csv":
            rows.write.option("header", True).csv(folder)
            read = lambda: spark.read.schema(rows.schema).option("header", True).csv(folder)
        else:
            rows.write.json(folder)
            read = lambda: files.read_ndjson(spark, folder, "event_id BIGINT, event_module STRING, client_ip STRING")
        name = f"logs-{fmt}"
        found = files.read_dataset(spark, name, {name: lambda s: files.with_ids(read(), name)})
        again = _reread(spark, read, f"{folder}-again")
        places = files.with_row_numbers(read(), "position", within_file=False).select("event_id", "position")
        same = F.count(F.lit(1)).over(Window.partitionBy("_id")) == 1
        out = found.withColumn("is_unique", same).join(again, "event_id").join(places, "event_id")
        return out.select("event_id", "_index", "client_ip", "position", "is_unique", (F.col("_id") == F.col("again")).alias("stable"))

    return run


#: Where the archive ends and recent activity begins.
_EDGE = "2000-10-01"


def archive_recent_accounts(spark, sf):
    (tx,) = load(spark, sf, "transactions")
    name = archive.store_archive(tx.where(f"timestamp < TIMESTAMP '{_EDGE}'"), scratch_dir(spark, "archive"))
    return archive.recent_accounts(spark.table(name), tx.where(f"timestamp >= TIMESTAMP '{_EDGE}' AND timestamp < TIMESTAMP '{_EDGE}' + INTERVAL 30 DAYS"))


_ARCHIVE_SQL = f"""WITH r AS (SELECT accountID, count(*) AS recent_n, min(year) AS y FROM {TX} AS t
  WHERE timestamp >= TIMESTAMP '{_EDGE}' AND timestamp < TIMESTAMP '{_EDGE}' + INTERVAL 30 DAY GROUP BY accountID)
SELECT t.accountID AS accountID, any_value(recent_n) AS recent_n, count(*) AS archive_n, max(year) AS last_year, CAST(sum(CAST(event_amount AS DECIMAL(18,2))) AS DOUBLE) AS archive_amount
FROM {TX} AS t JOIN r ON t.accountID = r.accountID AND t.year BETWEEN r.y - 2 AND r.y - 1 WHERE timestamp < TIMESTAMP '{_EDGE}' GROUP BY t.accountID"""


def _sql(fmt: str) -> str:
    return f"""SELECT CAST(_id AS BIGINT) AS event_id, 'logs-{fmt}' AS _index, client_ip, row_number() OVER (ORDER BY CAST(_id AS BIGINT)) - 1 AS position,
  TRUE AS is_unique, TRUE AS stable FROM {LOGS} AS l"""


QUERIES: dict[str, tuple[Query, str | None]] = {"ids_from_csv": (_ids_from("csv"), _sql("csv")), "ids_from_ndjson": (_ids_from("ndjson"), _sql("ndjson")), "archive_recent_accounts": (archive_recent_accounts, _ARCHIVE_SQL)}
