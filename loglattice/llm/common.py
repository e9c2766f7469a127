"""Helpers of the operators: column names, row keys, written intermediates, and word arrays over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglattice.session import fits_broadcast, scratch_dir

#: Text bytes that the array code works on at once; a longer text is a chunk of its own.
CHUNK_BYTES = 4_000_000
#: Largest side of a join, in bytes of text, that is sent to every task where a shuffle of both sides costs more.
SIDE_BYTES = 8 << 20
#: The characters that separate words, as a Java and RE2 character class.
SPACES = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\v\f\r"
WORD = rf"[^{SPACES}]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def row_key(df: DataFrame) -> Column:
    """32 hex digits over all columns and their nulls: equal rows share a key, other rows do not."""
    cols = [column(c).cast("string") for c in df.columns]
    nulls = F.array(*[c.isNull() for c in cols])
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), nulls, *cols)), 16, "0") for seed in (1, 2)])


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write once under the shared checkpoint folder and read back, so later stages neither recompute nor lose it."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent_if_small(side: DataFrame, max_bytes: int = SIDE_BYTES) -> DataFrame:
    """A side of a join that is cheap to read, to be broadcast if it is measured to be small; beyond ``max_bytes`` both sides are shuffled."""
    return F.broadcast(side) if fits_broadcast(side, max_bytes) else side


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with about ``limit`` bytes of text each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield start, stop
        start = stop


def string_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_string())


class Words:
    """The words of some texts in one array: ``codes`` number equal words alike, ``starts`` has each text's first position."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))
        encoded = pc.dictionary_encode(lists.flatten())
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.vocabulary = encoded.dictionary
        blank = pc.equal(self.vocabulary, "").to_numpy(zero_copy_only=False)
        if blank.any():  # a text without a word splits into one empty string
            sizes[np.repeat(np.arange(len(sizes)), sizes)[blank[codes]]] = 0
            codes = codes[~blank[codes]]
        self.codes, self.sizes = codes, sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)])

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def sums(self, per_word: np.ndarray) -> np.ndarray:
        """Sum of a per-word value over each text."""
        total = np.concatenate([[0], np.cumsum(per_word)])
        return total[self.starts[1:]] - total[self.starts[:-1]]
