"""Connected components as rounds of joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursematch.llm.common import Store


def components(edges: DataFrame, store: Store, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): component is the smallest node reachable.

    Alternates two rewirings that keep connectivity and only move edges towards smaller nodes: every
    larger neighbour of a node is tied to the smallest one (large star), then the node and its smaller
    neighbours are (small star). When all edges point from a node to a node that points nowhere, the
    stars are the components; the number of rounds grows with the logarithm of the longest path. The
    minima aggregate before the shuffle; a node with very many edges is split by the skew join.
    Null nodes and self-links are ignored. No edges give no rows.
    """
    e = store.put(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("a is not null and b is not null and a != b").distinct(), "edges")
    for _ in range(max_rounds):
        up = e.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        stars = up.where("n > 1").select("u").limit(1).unionAll(
            e.join(e.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u").limit(1))
        if stars.isEmpty():
            break
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = e.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()
        parent = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(parent, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(parent.select("u", F.col("m").alias("v"))).distinct())
        nxt = store.put(small, "edges")
        store.drop(e)
        e = nxt
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
