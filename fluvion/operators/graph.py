"""Connected components of graphs too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component): the least node of the part that each node of edges (a, b) belongs to. Nodes without an edge have no row.

    In a round every node points to its least neighbour, or to itself if that is larger; pointers are followed to their ends by doubling,
    and each part found is one node of the next round's graph. At least half of the nodes that still have an edge go in a round. Every
    step is a written table, made by joins and aggregates over all nodes at once.
    """
    e = written(edges.where("a is not null and b is not null").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")), "graph-edges")
    found = e.select(F.col("a").alias("node")).union(e.select("b")).distinct().withColumn("component", F.col("node"))
    for _ in range(rounds):
        e = e.where("a <> b")
        both = e.select("a", "b").union(e.select("b", "a"))
        pointers = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")), "graph-pointers")
        if not pointers.take(1):
            return found
        while True:
            on = pointers.select(F.col("a").alias("to"), F.col("to").alias("next"))
            moved = written(pointers.join(on, "to").select("a", "to", "next"), "graph-pointers")
            pointers = moved.select("a", F.col("next").alias("to"))
            if not moved.where("to <> next").take(1):
                break
        for side in ("a", "b"):
            e = e.join(pointers.select(F.col("a").alias(side), F.col("to").alias(f"new_{side}")), side)
        e = written(e.select(F.col("new_a").alias("a"), F.col("new_b").alias("b")).where("a <> b").distinct(), "graph-edges")
        ends = pointers.select(F.col("a").alias("component"), "to")
        found = written(found.join(ends, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "graph-found")
    raise RuntimeError(f"components: not done after {rounds} rounds")
