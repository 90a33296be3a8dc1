"""Connected components of links between numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.storage import settled
from vitrine.operators.joins import lookup


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); the component is its smallest node.

    Alternates large stars (each node links its larger neighbours to its smallest one) and small stars (the same for
    smaller neighbours) until nothing changes: a few rounds, whatever the shape. A node's neighbours are never gathered:
    their minimum is aggregated in part before the shuffle, and ``lookup`` lets Spark split a hub's rows in the join. Each round is written
    to the shared folder, which cuts the lineage.
    """
    edges = settled(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = lookup(both, least, ["a"], "inner").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = lookup(large, least, ["a"], "inner")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").union(least).distinct()
        edges = settled(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b"), F.col("b")).distinct())
