"""Connected components of a table of links, by rounds of joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablespoon.session import stored


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link; a component is called by its smallest node.

    Alternates two steps until nothing changes: every node's larger neighbours are linked to its smallest neighbour, then
    every node's smaller neighbours are. Each step is one minimum per node, combined before the shuffle, and one join,
    so a node with very many links is only a skewed join key. The number of rounds grows with the logarithm of the size.
    """
    x, y = F.least(a, b).alias("v"), F.greatest(a, b).alias("u")
    edges = stored(links.where(F.col(a) != F.col(b)).select(x, y).distinct(), "links")
    seen = None
    while True:
        edges = stored(_star(_star(edges, True), False), "links")
        state = edges.agg(
            F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")
        ).first()
        if seen == state:
            break
        seen = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.distinct())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to the smallest node among the neighbours and the node."""
    both = edges.select("u", "v")
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.join(least, "u")
    if large:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select("u", F.col("m").alias("v"))
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
    return out.where("u > v").distinct()
