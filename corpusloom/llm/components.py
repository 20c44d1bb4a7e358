"""Connected components by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Both steps are
one grouping by node; a node's neighbours are never gathered, only their
minimum, so hubs of any degree are fine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (
        down.join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b), but for smallest ones.

    ``component`` is the smallest node that can be reached; it has no row of its
    own. Rounds grow with the logarithm of the longest path.
    """
    edges = stored(links.filter("a <> b").select("a", "b").distinct(), "edges")
    while True:
        starred = _small_star(_large_star(edges)).filter("a <> b").distinct()
        starred = stored(starred, "edges")
        # Done when every node hangs on one root and no root hangs on another node.
        ends = starred.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("root"))
        ends = ends.union(starred.select("b", F.lit(0), F.lit(1)).distinct())
        node = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("root").alias("root"))
        if not node.filter("hangs > 1 or hangs = 1 and root = 1").limit(1).count():
            return starred.select(F.col("a").alias("node"), F.col("b").alias("component"))
        edges = starred
