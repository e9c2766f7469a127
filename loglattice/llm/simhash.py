"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint of 64 bits is cut into 16 segments, each mapped to its number of set bits. Changing one bit moves one count by one, so the
Manhattan distance of two such points never exceeds the fingerprints' differing bits. Two grid points within distance 2 have a common
grid point within distance 1 of each; every distinct fingerprint therefore registers in its own cell and the 32 next to it, one equi-join
on the cell finds all pairs within the bound, and the exact bit count verifies them. Equal fingerprints are joined as one, so a group of
copies costs one row, however large.

A null or word-free text has fingerprint zero and links like any other. Null ids take part; a component's id is its smallest non-null id.
Repeated rows share a component. Columns with clashing names and empty tables are fine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglattice.llm.common import chunks, column, free_name, materialise, row_key
from loglattice.llm.components import components

#: Shingle length, hash seed, bits that may differ.
SHINGLE, SEED, MAX_BITS = 3, 42, 2
SEGMENTS, WIDTH = 16, 4
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BLOCK = 1 << 16


def fingerprint(text: str | None) -> int:
    """The signed 64-bit SimHash of a text's lower-cased word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(whole, SEED)], "<u8")
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: 1 - SHINGLE].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(whole[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _BLOCK):
        ones += np.unpackbits(hashes[i : i + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprints(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the text column replaced by the fingerprint ``name``."""
    at = rows.columns.index(text)
    fields = [f for i, f in enumerate(rows.schema.fields) if i != at]
    schema = T.StructType([*fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            found = [fingerprint(t) for start, stop in chunks(texts) for t in texts.slice(start, stop - start).to_pylist()]
            others = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*others, pa.array(found, pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def embedding_cell(fp: Column) -> Column:
    """All segment counts packed into one long, four bits each, shifted by one so that neighbours stay in range."""
    cell = F.lit(0).cast("long")
    for s in range(SEGMENTS):
        segment = F.shiftrightunsigned(fp, s * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1).cast("long"))
        cell = cell.bitwiseOR(F.shiftleft((F.bit_count(segment) + 1).cast("long"), s * 4))
    return cell


def links(prints: DataFrame) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of the distinct fingerprints ``prints(fp)`` that differ in at most ``MAX_BITS`` bits.

    Spark takes the cells of all fingerprints for as small as the fingerprints they come from, so without the hint the driver would broadcast them.
    """
    steps = F.array(F.lit(0).cast("long"), *[F.lit(sign * (1 << (4 * s))).cast("long") for s in range(SEGMENTS) for sign in (1, -1)])
    cells = prints.select("fp", embedding_cell(F.col("fp")).alias("cell")).select(
        "fp", F.explode(F.transform(steps, lambda d: F.col("cell") + d)).alias("cell")
    )
    left, right = cells.select(F.col("fp").alias("a"), "cell"), cells.select(F.col("fp").alias("b"), "cell")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    return left.hint("merge").join(right.hint("merge"), "cell").where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def classes(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """``nodes(fp, least)`` with the smallest ``least`` of the whole component under the links ``found(a, b)``."""
    roots = components(found).withColumnRenamed("node", "fp")
    joined = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = joined.where("root <> fp or root is null").select("root").distinct()
    linked = joined.join(lowest, "root", "left_semi").groupBy("root").agg(F.min("least").alias("lowest"))
    return joined.join(linked, "root", "left").select("fp", F.coalesce("lowest", "least").alias("least"))


def _classes(prints: DataFrame, least: Column) -> DataFrame:
    """``(fp, least)`` per distinct fingerprint, with the smallest ``least`` of its whole component."""
    nodes = materialise(prints.groupBy("fp").agg(least.alias("least")), "prints")
    return classes(nodes, links(nodes))


def keep_chosen(keyed: DataFrame, key: str, prints: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose ``key`` is in ``chosen(key)``, repeated rows once, without the key; ``prints`` has every row's key."""
    repeats = prints.groupBy("key").agg((F.count("*") > 1).alias("repeated"))
    chosen = materialise(chosen.join(repeats, "key"), "chosen").withColumnRenamed("key", key)
    once = keyed.join(chosen.where(~F.col("repeated")).select(key), key, "left_semi")
    many = keyed.join(chosen.where("repeated").select(key), key, "left_semi").dropDuplicates([key])
    return once.unionByName(many).drop(column(key))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row: 16 hex digits, and the smallest id reachable over links."""
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    prints = materialise(with_fingerprints(rows, "text", "fp"), "fingerprints")
    classes = _classes(prints, F.min("doc_id")).withColumnRenamed("least", "component_id")
    return prints.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component with all its columns: that of the smallest id, ids before nulls, then the smallest row key."""
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, row_key(docs))
    slim = keyed.select(column(key).alias("key"), column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    prints = materialise(with_fingerprints(slim, "text", "fp"), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("key")))
    chosen = _classes(prints, first).select(F.col("least.key").alias("key")).distinct()
    return keep_chosen(keyed, key, prints, chosen)
