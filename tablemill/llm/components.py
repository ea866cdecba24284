"""Connected components without links or labels on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.llm.common import Scratch, empty


def components(links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """node and component (its smallest node) of every node in links (a, b: long).

    Each round, a node's parent is whichever of itself and its neighbours has the smallest hash, and links are redrawn
    between parents. The order by hash is random, so the nodes that are left shrink by a constant factor on average, for
    stars, cliques and chains alike. A round's links and the nodes' labels so far are written to the shared folder.
    """
    order = lambda c: F.struct(F.xxhash64(F.lit(11), c).alias("h"), F.col(c).alias("n"))
    live = scratch.table(links.select("a", "b").where("a <> b").distinct(), f"{label}-0")
    nodes = live.select(F.col("a").alias("node")).union(live.select("b")).distinct().withColumn("at", F.col("node"))
    k = 0
    while not empty(live):
        k += 1
        both = live.select("a", "b").union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.least(F.min(order("b")), F.first(order("a"))).getField("n").alias("parent"))
        parent = scratch.table(parent, f"{label}-parent-{k}")
        nodes = scratch.table(nodes.join(parent, nodes.at == parent.a, "left").select("node", F.coalesce("parent", "at").alias("at")), f"{label}-nodes-{k}")
        pa, pb = parent.select("a", F.col("parent").alias("x")), parent.select(F.col("a").alias("b"), F.col("parent").alias("y"))
        moved = live.join(pa, "a").join(pb, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        live = scratch.table(moved, f"{label}-{k}")
    smallest = nodes.groupBy("at").agg(F.min("node").alias("component"))
    return nodes.join(smallest, "at").select("node", "component")
