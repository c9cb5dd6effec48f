"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.sources.scratch import stored


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One round over edges (a > b): every node's neighbours are tied to the least of them and the node.

    Large stars move a node's greater neighbours, small stars its lesser ones and the node itself.
    Minima are partial sums before the shuffle; a node with very many edges is a skewed join key only.
    """
    ends = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = ends.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    tied = ends.join(least, "a")
    if small:
        tied = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    else:
        tied = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each component, for all nodes that have an edge; null ends are dropped."""
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if mark == state:
            break
        state = mark
        now = stored(_stars(_stars(now, small=False), small=True), "edges")
    # Every edge now points from a node to its root.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
