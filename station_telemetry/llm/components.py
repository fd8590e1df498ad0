"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from station_telemetry.llm.common import stored


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them. Rows have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    near = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return near.union(own).where("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b), of long ids; root is the component's smallest.

    Stars are minima per node, combined before the shuffle, and joins that split hot nodes, so a
    hub is no task's burden. A round's rows are written, which cuts the lineage; rounds end when
    nothing changes, after about the logarithm of the longest chain.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.distinct(), "links")
    before = None
    while True:
        sign = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == before or sign[0] == 0:
            break
        before = sign
        edges = stored(_small(_large(edges).distinct()).distinct(), "links")
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.union(leaves.select(F.col("root").alias("node"), "root").distinct())
