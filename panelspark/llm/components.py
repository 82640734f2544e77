"""Connected components of a table of links, by alternating large-star and small-star steps (Kiveris et al. 2014).

Each step is a minimum over neighbours and a join; no component is gathered anywhere. Steps are stored in the shared folder,
so lineage stays short and a lost executor costs one step. The number of steps grows with the logarithm of the
longest chain, not with the number of links. The node with very many links is the least of its neighbourhood, and its links
don't change in the large-star step, so links are joined only to the nodes between others, which soon are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop_stored, stored

#: Nodes between others are broadcast up to so many; beyond it, they are joined by a shuffle.
BROADCAST_NODES = 1_000_000


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and the node itself, point to the smallest of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    both = edges.join(least, "u")
    return both.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _large_star(edges: DataFrame, between: DataFrame, few: bool) -> DataFrame:
    """Every node's larger neighbours point to the smallest node next to it: ``m`` for nodes between others, else the node. Edges have u > v."""
    b = between.select(F.col("u").alias("_node"), "m")
    return edges.join(F.broadcast(b) if few else b, F.col("v") == F.col("_node"), "left").select("u", F.coalesce("m", "v").alias("v")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """From links (a, b) of long ids: node, component (the smallest node reachable). Nodes without links are left out."""
    spark = links.sparkSession
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = stored(edges, "links")
    while True:
        up = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        between = stored(up.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u", "m"), "between")
        n = between.limit(BROADCAST_NODES + 1).count()
        if n == 0 and up.filter("n > 1").limit(1).count() == 0:
            break  # every node leads straight to the least of its component
        new = stored(_small_star(_large_star(edges, between, n <= BROADCAST_NODES)), "links")
        drop_stored(spark, edges, between)
        edges = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
