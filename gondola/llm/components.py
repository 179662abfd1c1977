"""Connected components of a table of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gondola.llm.common import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every linked node; a component is named after its smallest node.

    Large and small stars in turn: links are hung from a node's smallest neighbour until every node hangs
    from its component's smallest. The number of links never grows. A node with very many links is one
    grouped row on one side of a join and many separate rows on the other.
    """
    edges = cut(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
        state = now
        both = edges.union(edges.select("v", "u"))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = cut(both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.union(lowest.select("u", F.col("m").alias("v"))).where("u != v").distinct())
