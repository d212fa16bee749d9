"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import settled


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every linked id, root the least id of its component. links: (a, b), any order and repeats.

    Each step keeps one row per node and neighbour at most and needs only minima per node, combined
    before the shuffle; the number of steps grows with the logarithm of the longest path.
    """
    edges = settled(links.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: what is larger than a node is tied to the least of the node and its neighbours.
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        edges = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its lesser neighbours are tied to the least of them.
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        tied = edges.join(low, "a")
        edges = settled(tied.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("id"), "root").distinct())
