"""Readers and writers for the file layouts: Parquet, CSV, newline-delimited JSON and object storage."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglattice.operators.lookup import lookup_join
from loglattice.session import scratch_dir

ROSTER_DDL = (
    "IP_Address STRING, First_Name STRING, Last_Name STRING, Department STRING, `Sub-Department` STRING, "
    "Start_Date STRING"
)
ROSTER_NAMES = {
    "IP_Address": "ip_address",
    "First_Name": "first_name",
    "Last_Name": "last_name",
    "Department": "department",
    "Sub-Department": "sub_department",
    "Start_Date": "start_date",
}
EVENT_NAMES = {
    "@timestamp": "event_ts",
    "client.ip": "client_ip",
    "source.ip": "source_ip",
    "host.ip": "host_ip",
    "destination.ip": "destination_ip",
    "event.module": "event_module",
    "destination.geo.country_name": "destination_country",
}
TRANSACTION_DDL = (
    "accountID INT, event_amount DOUBLE, event_type STRING, account_type STRING, account_event STRING, "
    "transaction_date STRING, timestamp TIMESTAMP, deposit_type STRING, wire_direction STRING, posID INT, "
    "txbankId INT, addressId INT, intbankID INT, to_account INT, security_symbol STRING, security_type STRING, "
    "quantity DOUBLE, price_per_unit DOUBLE, settlement_date STRING, counterparty_account INT, brokerID INT, "
    "tradeID STRING, data_origin STRING"
)


#: Shuffled bytes that make a file of ``write_partitions``; the tasks of joins get less at a time (``session.SETTINGS``).
FILE_BYTES = "64m"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def to_snake(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename dotted and hyphenated names once, at the source edge."""
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def from_snake(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    back = {new: old for old, new in names.items()}
    return df.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in df.columns])


def read_roster(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    reader = spark.read.schema(ROSTER_DDL)
    df = reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
    return to_snake(df, ROSTER_NAMES)


def write_roster(df: DataFrame, path: str, fmt: str = "csv") -> None:
    out = from_snake(df, ROSTER_NAMES)
    if fmt == "csv":
        out.write.mode("overwrite").option("header", True).csv(path)
    else:
        write_parquet(out, path)


def read_transactions(spark: SparkSession, path: str, partitioned: bool = True) -> DataFrame:
    """Transactions, flat or under ``year=/month=`` folders."""
    ddl = TRANSACTION_DDL + (", year INT, month INT" if partitioned else "")
    return spark.read.schema(ddl).parquet(path)


def months_between(df: DataFrame, start, end) -> DataFrame:
    """Restrict to a time range, with the partition predicate that ``timestamp`` alone would not give."""
    month_no = F.col("year") * 12 + F.col("month")
    return df.where(
        month_no.between(start.year * 12 + start.month, end.year * 12 + end.month)
        & F.col("timestamp").between(F.lit(start), F.lit(end))
    )


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Raw messages, one string column; a message may hold line breaks."""
    return spark.read.schema("message STRING").parquet(path)


def read_ndjson(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).json(path)


def write_ndjson(df: DataFrame, path: str, column: str = "message") -> None:
    """One document per line; line breaks inside a document become spaces."""
    flat = df.select(F.regexp_replace(column, "\\n", " ").alias("value"))
    flat.write.mode("overwrite").text(path)


def write_parquet(df: DataFrame, path: str, row_group_bytes: int | None = None) -> None:
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def write_partitions(
    df: DataFrame, path: str, cols: Sequence[str], cluster: bool = True, sort_by: str | None = None,
    max_rows_per_file: int = 20_000_000,
) -> None:
    """Partitioned Parquet; only the partitions present in ``df`` are replaced.

    ``cluster`` brings the rows of one partition value together so a folder gets few files. The rebalance lets
    adaptive execution split a large value over several tasks. ``sort_by`` orders rows inside each file so row groups
    can be skipped.
    """
    out = df.hint("rebalance", *cols) if cluster else df
    if sort_by:
        out = out.sortWithinPartitions(*cols, sort_by)
    conf = df.sparkSession.conf
    held = conf.get(_ADVISORY)
    conf.set(_ADVISORY, FILE_BYTES)
    try:
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .option("maxRecordsPerFile", max_rows_per_file)
            .partitionBy(*cols)
            .parquet(path)
        )
    finally:
        conf.set(_ADVISORY, held)


def results_json(df: DataFrame, column: str = "result") -> DataFrame:
    """Every row as one JSON text."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(column))


def with_row_numbers(df: DataFrame, name: str = "row_number", within_file: bool = True) -> DataFrame:
    """Rows of a frame as read from files of any format, numbered from zero in the order of the text, within each file or over all files by path.

    Rows are counted per split of a file, and a split begins where the ones before it end. So the numbers do not depend on how the files were
    split, and no row is moved: only the counts, one per split, are joined. The count reads every column, as formats may skip broken or empty
    lines that a narrower read would count. Filters belong after this, rows that ``DROPMALFORMED`` drops are not counted.
    """
    taken = {"in_file": F.col("_metadata.file_path"), "split_start": F.col("_metadata.file_block_start"), "place": F.monotonically_increasing_id()}
    placed = df.select("*", *[column.alias(f"__{c}") for c, column in taken.items()])
    keys = ["__in_file", "__split_start"]
    read = F.bit_xor(F.xxhash64(*[F.to_json(F.struct(f"`{c}`")) if dtype.startswith("map") else F.col(f"`{c}`") for c, dtype in df.dtypes]))
    counts = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.min("__place").alias("first"), read.alias("read"))
    path = scratch_dir(df.sparkSession, "split-counts")
    counts.write.parquet(path)
    stored = df.sparkSession.read.schema(counts.schema).parquet(path)
    order = Window.partitionBy("__in_file").orderBy("__split_start") if within_file else Window.orderBy(*keys)  # one row per split
    before = F.coalesce(F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = stored.select(*keys, (before - F.col("first")).alias("__shift"))
    numbered = lookup_join(placed, shifts, keys, skewed=False)
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__place") + F.col("__shift")).alias(name), "__in_file")


def with_ids(df: DataFrame, index: str) -> DataFrame:
    """Document ids that stay the same between runs: source key if present, else file path and row position, for any file format.

    Parquet knows its row positions. Other formats are counted per split first (``with_row_numbers``). The ids do not change with the size of the
    splits, and they differ for equal lines.
    """
    if "_id" in df.columns:
        return df.withColumn("_index", F.lit(index))
    if "row_index" in df.select("_metadata").schema["_metadata"].dataType.names:
        place = F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))
        return df.select("*", F.sha2(place, 256).alias("_id"), F.lit(index).alias("_index"))
    numbered = with_row_numbers(df, "__row")
    place = F.concat_ws("#", "__in_file", F.col("__row").cast("string"))
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], F.sha2(place, 256).alias("_id"), F.lit(index).alias("_index"))


def union_datasets(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Several datasets under one name; absent columns are null, ``_index`` keeps the concrete name."""
    tagged = [df.withColumn("_index", F.lit(name)) for name, df in datasets.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def read_dataset(
    spark: SparkSession,
    name: str,
    catalog: Mapping[str, Callable[[SparkSession], DataFrame]],
    aliases: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Resolve a dataset name, a trailing-``*`` pattern or an alias against ``catalog``; every row has its dataset's name as ``_index``."""
    if aliases and name in aliases:
        names = list(aliases[name])
    elif name.endswith("*"):
        names = sorted(n for n in catalog if n.startswith(name[:-1]))
    else:
        names = [name]
    if not names:
        raise ValueError(f"no dataset matches {name}")
    return union_datasets({n: catalog[n](spark) for n in names})


def s3_conf(endpoint: str, region: str = "us-east-1", anonymous: bool = True) -> dict[str, str]:
    """Session settings for an S3-compatible object store."""
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.endpoint.region": region,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https")).lower(),
    }
    if anonymous:
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = (
            "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"
        )
    return conf
