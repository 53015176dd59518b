"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable by links (a, b).

    Each round hangs every neighbour on the smallest one seen; rounds end when
    the links no longer change, after about log2 of the longest chain.  Nodes
    without links do not appear.  Group minima are combined before each
    shuffle, and the joins back to a node's links are plain equi-joins.
    """
    e = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first())

    seen = state(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(hung.union(low.select("u", F.col("m").alias("v"))).distinct())
        now = state(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    parent = e.groupBy("u").agg(F.min("v").alias("component"))
    return parent.select(F.col("u").alias("node"), "component").union(
        parent.select(F.col("component").alias("node"), "component").distinct())
