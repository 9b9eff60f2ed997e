"""The network of reaches: centerline vertices by reach, shared vertices at the ends, neighbours put together along the flow."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fits

# Types of reaches (last digit of the id) that heights aren't carried across: disconnected lake, dam, unknown topology. Ghost reaches.
UNCONNECTED, GHOST = (3, 4, 5), 6


def vertices_of(centerlines: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """reach_id, then the columns of centerlines but reach_ids, and is_extra: the vertices of every reach (of those in ids).

    A vertex names the reaches that it belongs to in reach_ids, its own first and up to three neighbours; 0 and null are none. It is extra for
    a reach that stands behind the first place. A reach that a vertex names twice has it once. Order them by cl_id.
    """
    rest = [c for c in centerlines.columns if c != "reach_ids"]
    named = centerlines.select(*rest, F.posexplode("reach_ids").alias("place", "reach_id")).where("reach_id <> 0")
    if ids is not None:
        named = named.join(ids.select("reach_id").distinct(), "reach_id", "left_semi")
    values = [F.first(c).alias(c) for c in rest if c != "cl_id"]
    return named.groupBy("reach_id", "cl_id").agg(*values, (F.max("place") > 0).alias("is_extra")).select("reach_id", *rest, "is_extra")


def with_shared_ends(vertices: DataFrame, limit: float = 50.0) -> DataFrame:
    """reach_id, seq, cl_id, x, y of a reach's centerline in order, with the extra vertices that continue one of its ends.

    vertices: reach_id, cl_id, x, y, is_extra. Extra vertices are taken in order of cl_id. One within limit of the start, or of a vertex put in
    there before, goes in before the nearest of these; else one within limit of the end goes in behind the nearest there; others are left out.
    """

    def kernel(cl: np.ndarray, x: np.ndarray, y: np.ndarray, extra: np.ndarray) -> dict[str, np.ndarray]:
        line = np.flatnonzero(~extra.astype(bool)).tolist()
        heads = tails = 0

        def near(places: list[int], k: int) -> tuple[int, float]:
            d = np.hypot(x[places] - x[k], y[places] - y[k])
            return int(d.argmin()), float(d.min())

        for k in np.flatnonzero(extra.astype(bool)).tolist() if line else ():
            at, d = near(line[: heads + 1], k)
            if d < limit:
                line.insert(at, k)
                heads += 1
                continue
            at, d = near(line[-(tails + 1) :], k)
            if d < limit:
                line.insert(len(line) - tails + at, k)
                tails += 1
        return {"seq": np.arange(len(line)), "cl_id": cl[line], "x": x[line], "y": y[line]}

    return fits.by_reach(vertices, ["cl_id", "x", "y", "is_extra"], kernel, "seq long, cl_id long, x double, y double")


def _first_connected(ids: str) -> Column:
    """The first id that heights may be carried to. 0 and null end the list."""
    given = F.filter(F.col(ids), lambda k: k.isNotNull() & (k != 0) & ~(k % 10).isin(*UNCONNECTED))
    return F.try_element_at(given, F.lit(1))


def neighbours(reaches: DataFrame, prior: DataFrame, observed: DataFrame, gap: float = 300.0, more_than: int = 5) -> DataFrame:
    """reach_id, side (-1 downstream, 1 upstream), other: which reach continues a reach on each side.

    reaches: reach_id, up, down (ids, the main one first). prior: reach_id, node_id, x, y, nodes numbered upstream. observed: reach_id, node_q. Of
    either list the first reach of a connected type is tried on both sides, the downstream one first, the later one that fits counts: more
    than more_than of its nodes aren't bad (node_q < 3), and its end is within gap of this reach's. So the ends decide, not the lists.
    """
    first, last = F.min_by(F.struct("x", "y"), "node_id"), F.max_by(F.struct("x", "y"), "node_id")
    ends = prior.groupBy("reach_id").agg(first.alias("first"), last.alias("last"))
    fair = observed.groupBy("reach_id").agg(F.count_if(F.col("node_q") < 3).alias("n")).where(F.col("n") > more_than).select(F.col("reach_id").alias("other"))
    tried = F.explode(F.array(F.struct(F.lit(0).alias("turn"), _first_connected("down").alias("other")), F.struct(F.lit(1).alias("turn"), _first_connected("up").alias("other"))))
    pairs = reaches.select("reach_id", tried.alias("t")).select("reach_id", "t.turn", "t.other").where("other is not null")
    pairs = pairs.join(fair, "other", "left_semi").join(ends, "reach_id").join(ends.select(F.col("reach_id").alias("other"), F.col("first").alias("other_first"), F.col("last").alias("other_last")), "other")
    away = lambda a, b: F.hypot(F.col(f"{a}.x") - F.col(f"{b}.x"), F.col(f"{a}.y") - F.col(f"{b}.y"))
    sides = F.explode(F.array(F.struct(F.lit(-1).alias("side"), away("other_last", "first").alias("d")), F.struct(F.lit(1).alias("side"), away("other_first", "last").alias("d"))))
    met = pairs.select("reach_id", "turn", "other", sides.alias("s")).where(F.col("s.d") < gap)
    return met.groupBy("reach_id", F.col("s.side").alias("side")).agg(F.max_by("other", "turn").alias("other"))


def stitched(reaches: DataFrame, prior: DataFrame, observed: DataFrame, gap: float = 300.0, more_than: int = 5, all_nodes: bool = True) -> DataFrame:
    """Every reach's nodes with those of the reaches that continue it: reach_id, part (-1 downstream, 0 own, 1 upstream), other (whose node it is) and ss.

    prior has s, the distance along a reach; ss runs on across the reaches' borders, from the downstream neighbour's start. observed: reach_id,
    node_id, node_q and any other columns. Neighbours give their observed nodes, the reach itself all its prior nodes, with nulls where
    nothing was observed (only the observed ones without all_nodes).
    """
    found = neighbours(reaches, prior, observed, gap, more_than)
    long = prior.groupBy("reach_id").agg(F.max("s").alias("long"))
    down = found.where("side = -1").join(long.withColumnRenamed("reach_id", "other"), "other").select("reach_id", F.col("long").alias("down"))
    own = reaches.select("reach_id").join(long, "reach_id").join(down, "reach_id", "left").select("reach_id", F.coalesce("down", F.lit(0.0)).alias("down"), "long")
    parts = found.select("reach_id", F.col("side").alias("part"), "other").unionByName(own.select("reach_id", F.lit(0).alias("part"), F.col("reach_id").alias("other")))
    start = F.when(F.col("part") == -1, 0.0).when(F.col("part") == 0, F.col("down")).otherwise(F.col("down") + F.col("long"))
    parts = parts.join(own, "reach_id").select("reach_id", "part", "other", start.alias("start"))
    values = [c for c in observed.columns if c not in ("reach_id", "node_id")]
    nodes = prior.select(F.col("reach_id").alias("other"), "node_id", "s").join(observed.withColumnRenamed("reach_id", "other").withColumn("_seen", F.lit(True)), ["other", "node_id"], "left")
    met = parts.join(nodes, "other").where(F.col("_seen") | ((F.col("part") == 0) if all_nodes else F.lit(False)))
    return met.select("reach_id", "part", "other", "node_id", (F.col("start") + F.col("s")).alias("ss"), *values)
