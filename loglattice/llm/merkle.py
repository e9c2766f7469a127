"""Merkle manifest of a dataset: nodes labelled with the interval of leaf ranks that they cover.

Leaves are ranked over the whole table by group, id and digest. A node of a group's tree covers the ranks of its leaves, and the tree over the
groups' roots covers whole groups. Going up, every ``FANOUT`` consecutive nodes become one; going down, a node meets its parent in the one
bucket of the parent's level that its interval lies in, the parent's interval contains it, and what the parent covers besides, left and right
of it, belongs to its siblings. Each level is a grouping or a join by (tree, bucket), of at most ``FANOUT`` rows a key, so no group, however
large, meets in one task. Ranks come from a range partitioning, each partition's rows counted from the partitions' sizes.

A field counts as ``-`` if null, else as its length in bytes, ``:`` and its text. Null groups form one group, before all others; an empty text
is a group of its own. Null ids come first in their group; rows of one id are ordered by their digests, equal rows in any order, each with a
proof. Other columns are ignored, whatever their names. An empty table has no rows and no root.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglattice.llm.common import column, materialise

#: Children of a node, and a leaf's fields in their order.
FANOUT, FIELDS = 16, ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string,right:string>>"
#: ``monotonically_increasing_id`` has the row's place within its partition in this many bits.
_PLACE_BITS = 33


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else byte count, colon and text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return digest(F.concat(*map(encoded, fields)))


def ranked(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Stored ``rows`` with ``part`` and ``place`` in the order of the columns, nulls first; and the ``before`` of every part.

    A row's rank is its part's ``before`` plus its ``place``. Rows that agree in all columns of the order take any order among them, and so
    may lie in several parts.
    """
    stored = materialise(rows.withColumn("tie", F.monotonically_increasing_id()), "unranked")
    in_order = stored.repartitionByRange(*order, "tie").sortWithinPartitions(*order, "tie").drop("tie").withColumn("at", F.monotonically_increasing_id())
    place = F.col("at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    placed = materialise(in_order.withColumn("part", F.shiftright("at", _PLACE_BITS)).withColumn("place", place).drop("at"), "ranked")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))  # one row a partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed, sizes.select("part", before.alias("before"))


_NODE = ("tree", "size", "at", "lo", "hi", "digest")


def bucket(level: int) -> Column:
    """The bucket of that level in which a node lies: its ordinal in its tree over the level's width."""
    return F.shiftright("at", level * (FANOUT.bit_length() - 1))


def grow(leaves: DataFrame, largest: int) -> list[DataFrame]:
    """All levels over ``leaves(tree, size, at, lo, hi, digest)``: ``at`` numbers the ``size`` leaves of a tree from zero; at most ``largest`` each."""
    levels = [leaves.select(*_NODE)]
    while largest > FANOUT ** (len(levels) - 1):
        level = len(levels)
        children = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))
        several = levels[-1].where(F.col("size") > FANOUT ** (level - 1))
        nodes = several.groupBy("tree", "size", bucket(level).alias("bucket")).agg(
            F.min("at").alias("at"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), children.alias("children")
        )
        levels.append(materialise(nodes.drop("bucket").withColumn("digest", digest(F.array_join("children.digest", ""))), f"level-{level}"))
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """The one node that remains of each tree: the first level that is one node wide."""
    ends = [nodes.where(F.col("size") <= FANOUT**k).where(F.col("size") > (FANOUT ** (k - 1) if k else 0)).select(*_NODE) for k, nodes in enumerate(levels)]
    return reduce(DataFrame.unionByName, ends)


def _joined(children: Column) -> Column:
    return F.array_join(F.transform(children, lambda c: c["digest"]), "")


def with_path(nodes: DataFrame, level: int, parents: DataFrame | None, ends: DataFrame, passed: Sequence[str]) -> DataFrame:
    """``nodes`` of ``level`` with ``path``: their siblings left and right of them, then those of every ancestor up to the root.

    ``parents`` are the nodes of the next level with children and path; ``ends(tree, path)`` is the path of a tree's root. The columns
    ``passed`` come down with the path.
    """
    last = nodes.where(F.col("size") <= FANOUT**level).join(ends.select("tree", "path", *passed), "tree")
    if parents is None:
        return last
    above = parents.select(
        "tree", bucket(level + 1).alias("bucket"), F.col("lo").alias("from"), F.col("hi").alias("to"), F.col("children").alias("family"), F.col("path").alias("upper"), *passed
    )
    contained = (F.col("from") <= F.col("lo")) & (F.col("hi") <= F.col("to"))
    met = nodes.where(F.col("size") > FANOUT**level).withColumn("bucket", bucket(level + 1)).join(above, ["tree", "bucket"]).where(contained)
    # The parent's interval without the node's: [from, lo) holds the siblings on its left, [hi, to) those on its right.
    left = _joined(F.filter("family", lambda c: c["hi"] <= F.col("lo"))).alias("left")
    right = _joined(F.filter("family", lambda c: c["lo"] >= F.col("hi"))).alias("right")
    path = F.concat(F.array(F.struct(left, right)), F.col("upper"))
    return met.withColumn("path", path).select(*nodes.columns, "path", *passed).unionByName(last)


def paths(levels: list[DataFrame], ends: DataFrame, passed: Sequence[str]) -> DataFrame:
    """The leaves with their paths, level by level from the top."""
    above = None
    for level in range(len(levels) - 1, -1, -1):
        above = with_path(levels[level], level, above, ends, passed)
    return above


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(path, start, lambda h, x: digest(F.concat(x["left"], h, x["right"])))


def prove(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` (with ``digest``) and each one's ``path``, ``subroot`` and ``root``: a tree per ``group`` in the order given, and one over all.

    The rows' names must differ from those of the labels: tree, size, at, lo, hi, part, place, before, bucket, path, subroot, root.
    """
    placed, before = ranked(rows, [group, *order, "digest"])
    blocks = placed.groupBy("part", group).agg(F.count("*").alias("n"), F.min("place").alias("place")).join(before, "part")
    blocks = materialise(blocks.withColumn("lo", F.col("before") + F.col("place")).drop("place"), "blocks")
    groups, earlier = ranked(blocks.groupBy(group).agg(F.min("lo").alias("start"), F.sum("n").alias("size")), ["start"])
    tree = (F.col("before") + F.col("place")).alias("tree")
    groups = materialise(groups.join(earlier, "part").select(F.col(group).alias("name"), tree, "start", "size"), "groups")
    count, largest = groups.agg(F.count("*"), F.max("size")).first()
    known = blocks.select(F.col("part").alias("in_part"), group, "before").join(groups, F.col(group).eqNullSafe(F.col("name"))).drop(group)
    rank = F.col("before") + F.col("place")
    leaves = placed.join(known, (F.col("part") == F.col("in_part")) & F.col(group).eqNullSafe(F.col("name"))).select(
        *rows.columns, "tree", "size", (rank - F.col("start")).alias("at"), rank.alias("lo"), (rank + 1).alias("hi")
    )
    levels = grow(leaves, largest or 0)
    one = F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("size")
    upper = grow(materialise(roots(levels).select(*one, F.col("tree").alias("at"), "lo", "hi", "digest"), "subroots"), count)
    top = roots(upper).select("tree", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    ends = paths(upper, top, ["root"]).select(F.col("at").alias("tree"), "path", "root", F.col("digest").alias("subroot"))
    return paths([leaves, *levels[1:]], materialise(ends, "group-paths"), ["root", "subroot"])


def verify(docs: DataFrame, fields: Sequence[str] = FIELDS, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Each row's leaf, roots and proof, and whether a copy tampered with still gives the root.

    Tampering lower-cases A-Z of the text where 5 divides the unsigned CRC-32 of the decimal id.
    """
    values = [column(c) for c in fields]
    changed = [F.translate(column(c).cast("string"), UPPER, LOWER) if c == text else column(c) for c in fields]
    tampered = F.crc32(column(doc_id).cast("string").cast("binary")) % 5 == 0
    rows = docs.select(
        column(doc_id).alias("doc_id"), column(source).alias("source"), leaf(values).alias("digest"), F.when(tampered, leaf(changed)).alias("changed")
    )
    proof = F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), "")
    folded = fold(F.coalesce("changed", "digest"), F.col("path"))
    found = prove(rows, "source", ["doc_id"]).withColumn("folded_root", folded)
    return found.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", digest(proof).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified")
    )
