"""Exact nearest neighbours in the plane by rings of cells that grow until they suffice."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written


def around(x: str, y: str, cell: float):
    """The nine cells in and around that of a place, as rows (cx, cy)."""
    steps = [F.struct((F.floor(F.col(x) / cell) + i).alias("cx"), (F.floor(F.col(y) / cell) + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    return F.explode(F.array(*steps))


def within_cell(points: DataFrame, nodes: DataFrame, cell: float, by: list[str] | None = None) -> DataFrame:
    """Pairs of points and nodes at most cell apart, with their squared distance d2: the columns of both (of equal name: those of points).

    Points have columns x, y, nodes nx, ny; columns in by must be equal, too. The nodes, which are few, are dealt to nine cells, so
    every point meets the nodes of its neighbourhood by one key.
    """
    by = by or []
    dealt = nodes.withColumn("_c", around("nx", "ny", cell)).withColumns({"_cx": F.col("_c.cx"), "_cy": F.col("_c.cy")}).drop("_c")
    placed = points.withColumns({"_cx": F.floor(F.col("x") / cell), "_cy": F.floor(F.col("y") / cell)})
    dx, dy = F.col("x") - F.col("nx"), F.col("y") - F.col("ny")
    return placed.join(dealt, [*by, "_cx", "_cy"]).withColumn("d2", dx * dx + dy * dy).where(F.col("d2") <= cell * cell).drop("_cx", "_cy")


def _lists(nodes: DataFrame, columns: list[str], cell: float, by: list[str], group: str | None = None) -> DataFrame:
    """by, group, _cx, _cy and _nodes: the sorted structs of columns of the nodes in and around each cell."""
    dealt = nodes.where("nx is not null and ny is not null").select("*", around("nx", "ny", cell).alias("_c")).withColumns({"_cx": F.col("_c.cx"), "_cy": F.col("_c.cy")}).drop("_c")
    here = [*by, "_cx", "_cy"]
    return dealt.repartition(*here).groupBy(*here, *([group] if group else [])).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("_nodes"))


def _squares() -> Column:
    """Squared distances of a point to _nodes."""

    def d2(n: Column) -> Column:
        dx, dy = F.col("x") - n["nx"], F.col("y") - n["ny"]
        return dx * dx + dy * dy

    return F.transform("_nodes", d2)


def nearest_within_cell(points: DataFrame, nodes: DataFrame, cell: float, columns: list[str], by: list[str] | None = None, group: str | None = None) -> DataFrame:
    """The columns of points, group and b (d2 and columns): the nearest node at most cell apart, of each group, with the least columns on ties.

    Columns in by must be equal, too. A point meets the nodes of its cell as one list for each group, so it is shuffled once, to its cell, and
    no pairs of points and nodes are sorted or shuffled. Repeated points are one. columns hold nx and ny. Lists are many times what a plan
    takes their nodes for, so they are never broadcast.
    """
    placed = points.withColumns({"_cx": F.floor(F.col("x") / cell), "_cy": F.floor(F.col("y") / cell)})
    here = [*(by or []), "_cx", "_cy"]
    placed = placed.repartition(*here).distinct()  # within the cell's partition: no shuffle of its own
    met = placed.join(_lists(nodes, columns, cell, by or [], group).hint("merge"), here).withColumn("_d", _squares()).withColumn("_d2", F.array_min("_d"))
    first = F.get("_nodes", (F.array_position("_d", F.col("_d2")) - 1).cast("int"))
    best = F.struct(F.col("_d2").alias("d2"), *(first[k].alias(k) for k in columns))
    # an outer generator, as a filter on _d2 would be put into the join and squares be made twice
    found = met.select(*points.columns, *([group] if group else []), F.explode_outer(F.when(F.col("_d2") <= cell * cell, F.array(best))).alias("b"))
    return found.where("b is not null")


def nearest(points: DataFrame, nodes: DataFrame, id: str, cell: float, farthest: float, group: str | None = None, carried: list[str] | None = None) -> DataFrame:
    """Each point's nearest node, all groups' if several are equally near: id, the carried columns of points (x and y, too, if named), d2 and the columns of nodes. Points farther than farthest from all have no row.

    Of a group's equally near nodes the one with the least columns, in their order, counts. A ring answers for the points that have a node within its cell, as
    no other node can be nearer; the others go on to one with twice the cell. Each ring is a written table, for which points are shuffled once. Lists of
    nodes are never broadcast.
    """
    own = [id, *(carried or [])]
    place = [k for k in ("x", "y") if k not in own]
    columns = [*([group] if group else []), *(c for c in nodes.columns if c != group)]
    open_points, found = points.select(*own, *place).where("x is not null and y is not null"), []
    while True:
        placed = open_points.withColumns({"_cx": F.floor(F.col("x") / cell), "_cy": F.floor(F.col("y") / cell)})
        met = placed.join(_lists(nodes, columns, cell, []).hint("merge"), ["_cx", "_cy"], "left").withColumn("_d", _squares()).withColumn("_d2", F.array_min("_d"))
        # nodes are sorted by group and columns, so the first of a group at the least distance is its least; mostly one node is that near
        one = F.array(F.struct(F.col("_d2").alias("_d"), F.get("_nodes", (F.array_position("_d", F.col("_d2")) - 1).cast("int")).alias("_nodes")))
        several = F.filter(F.arrays_zip("_d", "_nodes"), lambda p: p["_d"] == F.col("_d2"))
        least = F.when(F.size("_d") - F.size(F.array_remove("_d", F.col("_d2"))) == 1, one).otherwise(several)
        same = lambda p, k: (k == 0) | (p["_nodes"][group] != F.get("_least", k - 1)["_nodes"][group]) if group else k == 0
        near = F.col("_d2") <= cell * cell
        met = met.withColumn("_least", F.when(near, least))
        met = met.withColumn("_n", F.explode_outer(F.filter("_least", same)))
        ring = written(met.select(*own, *place, F.when(near, F.col("_d2")).alias("d2"), *(F.col("_n._nodes")[k].alias(f"_{k}") for k in columns)), "ring")
        found.append(ring.where("d2 is not null").select(*own, "d2", *(F.col(f"_{k}").alias(k) for k in columns)))
        open_points = ring.where("d2 is null").select(*own, *place)
        if cell >= farthest or not open_points.take(1):
            break
        cell = min(2 * cell, farthest)
    return functools.reduce(DataFrame.unionByName, found).select(*own, "d2", *nodes.columns)
