"""Connected components of a graph that no single machine has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.tables import store


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of an edge, the component named by its smallest node.

    Alternates two steps until nothing changes: every node points its larger neighbours to its smallest neighbour,
    then its smaller ones. The number of rounds grows with the logarithm of the longest path. A node with very many
    neighbours is combined per task where its minimum is taken, and its edges may be split where the minimum is joined
    back, since that minimum is stored first. Each round is stored, so a lost executor costs a read. Nulls and loops
    are ignored; repeated edges count once.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    now = store(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    before = None
    while (print_ := _fingerprint(now)) != before:
        before = print_
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = store(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        # Larger neighbours of u: the edges as stored, read from their smaller end.
        large = now.select(F.col("v").alias("u"), F.col("u").alias("far")).join(least, "u")
        now = store(large.select(F.col("far").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        least = store(now.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = now.join(least, "u")
        down = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = store(down.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    star = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.unionByName(star.select(F.col("component").alias("node"), "component").distinct())
