"""Line dedup by distinct-site spread.

Lines are trimmed and hashed. A HyperLogLog sketch of the sites per line hash is built in every task and merged by the aggregation. A
line whose estimate is clearly above the threshold is boilerplate, one clearly below is not; lines in between get exact distinct counts.
Boilerplate is removed from every document but the one with the smallest id, so a copied document keeps its text in one place.

Blank lines are never removed. A null text stays null; a null site counts as no site; with null ids the first holder is the smallest
non-null id, and if all are null every copy of the line goes. Repeated rows of the first holder all keep the line. Other columns, clashing
names and empty tables are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglattice.llm.common import SPACE_CHARS, column, free_name, materialise, row_key

#: Sites that a line must reach to be boilerplate.
MIN_SITES = 8
#: Sketch size, 2^k registers: a standard error of about 1.6 percent.
LOG_REGISTERS = 12
#: Share of the threshold on both sides within which the count is exact: more than ten standard errors.
BAND = 0.25


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE_CHARS))


def line_hash(line: Column) -> Column:
    """Null for a blank line."""
    return F.when(line != "", F.xxhash64(line))


def _lines(docs: DataFrame, text: str, *keep: Column) -> DataFrame:
    """``keep`` and the hash of every line with a word."""
    split = F.split(column(text), "\n")
    hashes = F.filter(F.transform(split, lambda x: line_hash(trimmed(x))), lambda h: h.isNotNull())
    return docs.select(*keep, F.explode(F.array_distinct(hashes)).alias("line"))


def boilerplate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``(line, first_id)`` of the lines on at least ``min_sites`` distinct sites, written and small beside the input."""
    rows = _lines(docs, text, column(doc_id).alias("id"), F.xxhash64(column(site).cast("string")).alias("site"), column(site).isNull().alias("none"))
    rows = rows.withColumn("site", F.when(~F.col("none"), F.col("site")))
    # A line of one site needs no sketch: two numbers per line tell it apart before any sketch is made.
    spread = rows.groupBy("line").agg(F.min("site").alias("low"), F.max("site").alias("high"), F.min("id").alias("first_id"), F.count("*").alias("n"))
    several = materialise(spread.where(F.col("low") < F.col("high")).where(F.col("n") >= min_sites).select("line", "first_id"), "shared-lines")
    pairs = rows.join(several, "line").select("line", "first_id", "site")
    sketched = pairs.groupBy("line").agg(F.hll_sketch_agg("site", LOG_REGISTERS).alias("sketch"), F.first("first_id").alias("first_id"))
    estimated = sketched.select("line", "first_id", F.hll_sketch_estimate("sketch").alias("sites"))
    estimated = materialise(estimated.where(F.col("sites") >= min_sites * (1 - BAND)), "line-sketches")
    sure = estimated.where(F.col("sites") > min_sites * (1 + BAND)).select("line", "first_id")
    near = estimated.where(F.col("sites") <= min_sites * (1 + BAND)).select("line")
    exact = pairs.join(near, "line", "left_semi").distinct().groupBy("line").agg(F.count("site").alias("sites"), F.first("first_id").alias("first_id"))
    return materialise(sure.unionByName(exact.where(F.col("sites") >= min_sites).select("line", "first_id")), "boilerplate")


def remove_boilerplate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES, removed: str | None = None
) -> DataFrame:
    """``docs`` with the boilerplate lines cut out of the text; ``removed`` names an added column with their number per row."""
    spread = boilerplate(docs, doc_id, text, site, min_sites)
    key, gone = free_name(docs, "row_key"), free_name(docs, "cut_lines")
    keyed = docs.withColumn(key, row_key(docs))
    hits = _lines(keyed, text, column(key), column(doc_id).alias("id")).join(spread, "line").where(~F.col("first_id").eqNullSafe(F.col("id")) | F.col("id").isNull())
    hits = hits.groupBy(column(key)).agg(F.collect_set("line").alias(gone))
    joined = keyed.join(materialise(hits, "line-hits"), key, "left")
    lines = F.split(column(text), "\n")
    stays = F.filter(lines, lambda x: F.coalesce(~F.array_contains(column(gone), line_hash(trimmed(x))), F.lit(True)))
    cut = F.when(column(gone).isNull(), column(text)).otherwise(F.array_join(stays, "\n"))
    out = [cut.alias(c) if c == text else column(c) for c in docs.columns]
    if removed:
        out.append(F.when(column(gone).isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(stays)).cast("long").alias(removed))
    return joined.select(*out)
