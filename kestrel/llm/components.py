"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node) of every node of the undirected ``a``-``b`` edges.

    Each round is two aggregations and joins; the rounds grow with the logarithm
    of the longest path, not with the size of a component. It ends when every
    node has one parent (a root is its own), which one aggregation tells; only
    the number of other nodes reaches the driver. Every round is written to the
    shared folder, so a lost executor costs one round at most.
    """
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    while True:
        parents = (edges.select(F.col("a").alias("node"), "b").unionByName(edges.select(F.col("b").alias("node"), "b"))
                   .groupBy("node").agg(F.min("b").alias("component"), F.max("b").alias("last")))
        if not parents.where("component <> last").agg(F.count(F.lit(1))).first()[0]:
            return parents.select("node", "component")
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        edges = staged(small, "cc")
