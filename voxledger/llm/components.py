"""Connected components of a table of links, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import checkpointed


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node in ``links(a, b)``; the component is its smallest node.

    Every round links each node's larger neighbours to its smallest one, then
    its smaller neighbours likewise, until nothing changes: a logarithmic
    number of rounds. Each round is cut by a checkpoint, so a lost executor
    costs one round at most, and a node with many neighbours is pre-aggregated
    before the shuffle and never gathered.
    """
    edges = checkpointed(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: larger neighbours go to the smallest of the neighbourhood
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: the node and its smaller neighbours go to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = checkpointed(small.select("e.*").where("u <> v").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(own).distinct()
