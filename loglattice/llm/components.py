"""Connected components by alternating large and small stars.

Every round is two joins over the links; the links left at the end form one star per component around its smallest node, which the smallest and
largest neighbour of every node tell. Smallest neighbours go to every task while they are few. Rounds are written under the shared checkpoint
folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglattice.llm.common import SIDE_BYTES, materialise
from loglattice.session import fits_broadcast

#: Rounds grow with the logarithm of the longest path; running out of them is an error, never a partial answer.
MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` to ``(node, root)`` for every linked node; ``root`` is the smallest node of the component."""
    edges = materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b"), "links")
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = materialise(both.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high")), "neighbours")
        least = near.select("a", F.least("low", "a").alias("m"))
        if near.where("low < a and low < high").isEmpty():  # each node has larger neighbours only, or a single one that is smaller
            return least.select(F.col("a").alias("node"), F.col("m").alias("root"))
        side = F.broadcast if fits_broadcast(least, SIDE_BYTES) else lambda nodes: nodes
        # Neither star has more rows than the links it comes from, so repeated ones are dropped once a round.
        large = edges.select(F.col("b").alias("a"), F.col("a").alias("b")).join(side(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large, "large-star")
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(side(lower), "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(small.unionByName(lower.select("a", F.col("m").alias("b"))).distinct(), "small-star")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
