"""Write enrichment back to stored documents: only the partitions that hold updated documents are rewritten.

The new partitions are first written to a staged copy under the shared scratch folder and then put in place from there, so no job
overwrites the files that it reads. Both steps may be repeated: a second run of the same updates gives the same table, and when the second
step is lost half-way, ``publish_update`` finishes it from the staged copy, which is left in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loglattice.operators.enrich import DOC_KEY, update_by_id
from loglattice.session import scratch_dir
from loglattice.sources import files


def touched_partitions(stored: DataFrame, updates: DataFrame, partitions: Sequence[str], doc_key: Sequence[str] = DOC_KEY) -> DataFrame:
    """The partition values, one row each, of the folders to rewrite; updates of absent folders name none."""
    if set(partitions) <= set(doc_key):
        return stored.select(*partitions).distinct().join(updates.select(*partitions).distinct(), list(partitions), "left_semi")
    return stored.join(updates.select(*doc_key).distinct(), list(doc_key), "left_semi").select(*partitions).distinct()


def stage_update(
    stored: DataFrame, updates: DataFrame, field: str, mode: str = "merge", partitions: Sequence[str] = ("_index",),
    doc_key: Sequence[str] = DOC_KEY, order: str | None = None,
) -> tuple[str, StructType]:
    """The rewritten partitions as a staged copy: its folder and the new schema.

    The touched folders' names go through the driver, which lists all of the table's folders anyway; as literals they keep the others
    from being read.
    """
    names = touched_partitions(stored, updates, partitions, doc_key).collect()
    if len(partitions) == 1:
        inside = F.col(partitions[0]).isin([row[0] for row in names])
    else:
        inside = F.struct(*partitions).isin([F.struct(*map(F.lit, row)) for row in names])
    changed = update_by_id(stored.where(inside), updates, field, mode, doc_key, order)
    staged = scratch_dir(stored.sparkSession, "write-back")
    files.write_parquet(changed, staged)
    return staged, changed.schema


def publish_update(
    spark: SparkSession, staged: str, schema: StructType, path: str, partitions: Sequence[str] = ("_index",),
) -> DataFrame:
    """Put the staged partitions in place and read the table; partitions without the new columns read as null there."""
    files.write_partitions(spark.read.schema(schema).parquet(staged), path, partitions)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def update_documents(
    spark: SparkSession, path: str, schema: StructType | str, updates: DataFrame, field: str, mode: str = "merge",
    partitions: Sequence[str] = ("_index",), doc_key: Sequence[str] = DOC_KEY, order: str | None = None,
) -> DataFrame:
    """Apply (document key, ``update`` struct) rows to the Parquet table at ``path``, partitioned by ``partitions``, and read it back.

    ``mode`` is ``merge`` (other keys of ``field`` stay) or ``replace``. Documents without an update keep what they have, also those with a
    null id. An empty text as partition value is stored as null.
    """
    stored = spark.read.schema(schema).parquet(path)
    staged, new_schema = stage_update(stored, updates, field, mode, partitions, doc_key, order)
    return publish_update(spark, staged, new_schema, path, partitions)
