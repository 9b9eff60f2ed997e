"""Queries on centerlines: resampling and refinement."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fits, refine
from .catalogue import c, query, r, table

# straight lines with vertices at uneven distances, some twice
_STRAIGHT = """v as (select p_partkey // 12 as reach_id, p_partkey as seq, (p_partkey % 12 - p_partkey % 12 % 5 // 4) * 130.0 + p_partkey % 12 // 3 * 17 as d from part),
o as (select reach_id, d - min(d) over (partition by reach_id) as d from v), n as (select reach_id, max(d) as long, cos(reach_id * 0.37) as tx, sin(reach_id * 0.37) as ty from o group by 1 having max(d) > 0)"""


def _straight(spark, sf_dir):
    k = c("p_partkey")
    v = table(spark, sf_dir, "part").select(F.floor(k / 12).alias("reach_id"), k.alias("seq"), ((k % 12 - F.floor(k % 12 % 5 / 4)) * 130.0 + F.floor(k % 12 / 3) * 17).alias("d"))
    low = v.groupBy("reach_id").agg(F.min("d").alias("low"))
    turn = c("reach_id") * 0.37
    return v.join(low, "reach_id").select("reach_id", "seq", ((c("d") - c("low")) * F.cos(turn)).alias("x"), ((c("d") - c("low")) * F.sin(turn)).alias("y"))


@query(f"""with {_STRAIGHT}, p as (select reach_id, unnest(range(floor((long + 1e-6) / 30)::bigint)) as vertex_id, tx, ty from n)
select reach_id, vertex_id, round((vertex_id + 0.5) * 30, 3) as s, round((vertex_id + 0.5) * 30 * tx, 3) + 0.0 as x, round((vertex_id + 0.5) * 30 * ty, 3) + 0.0 as y, round(tx, 5) as tx, round(ty, 5) as ty from p""")
def centerline_resampled(spark, sf_dir):
    """Lines resampled every 30 m; on straight ones the spline is the line."""
    out = fits.centerlines(_straight(spark, sf_dir), 30.0)
    return out.select("reach_id", "vertex_id", *(r(k, 3).alias(k) for k in ("s", "x", "y")), r("tx").alias("tx"), r("ty").alias("ty"))


_BANK = """pix as (select l_suppkey as reach_id, (l_orderkey * 8 + l_linenumber) * 20000000 + floor(l_extendedprice * 100 + 0.5)::bigint as pixel_id, l_partkey % 60 * 40 + l_quantity as x, l_extendedprice % 90 + l_suppkey % 7 * 9 - 60 as y from lineitem),
nodes0 as (select s_suppkey as reach_id, unnest(range(12)) as node_id, s_suppkey, from supplier), n0 as (select reach_id, node_id, node_id * 200.0::double as x, 0.0::double as y from nodes0)"""


def _moved(k: int) -> str:
    return f"""m{k} as (select p.reach_id, pixel_id, p.x, p.y, min(struct_pack(d2 := (p.x - n.x) * (p.x - n.x) + (p.y - n.y) * (p.y - n.y), node_id := node_id)) as b from pix p join n{k} n using (reach_id) group by all),
n{k + 1} as (select reach_id, b.node_id as node_id, avg(x) as x, avg(y) as y from m{k} where b.d2 <= 250000 group by 1, 2)"""


def _bank(spark, sf_dir):
    line = (c("l_orderkey") * 8 + c("l_linenumber")) * 20000000 + F.floor(c("l_extendedprice") * 100 + 0.5)
    pixels = table(spark, sf_dir, "lineitem").select(c("l_suppkey").alias("reach_id"), line.alias("pixel_id"), (c("l_partkey") % 60 * 40 + c("l_quantity")).alias("x"), (c("l_extendedprice") % 90 + c("l_suppkey") % 7 * 9 - 60).alias("y"))
    nodes = table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("reach_id"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(11).cast("long"))).alias("node_id"))
    return pixels, nodes.select("reach_id", "node_id", (c("node_id") * 200.0).alias("x"), F.lit(0.0).alias("y"), F.lit(1.0).alias("tx"), F.lit(0.0).alias("ty"))


@query(f"""with {_BANK}, {_moved(0)}, {_moved(1)} select reach_id, node_id, round(x, 4) as x, round(y, 4) as y from n2""".replace("s_suppkey, from", "s_suppkey from"))
def centerline_centroids(spark, sf_dir):
    """Two moves of the nodes to the centres of their pixels, without smoothing. The channel is wider than any pixel is away."""
    out = refine.refine_centerlines(*_bank(spark, sf_dir), max_width=1000.0, rounds=2, tol=0.0, smooth=None)
    return out.select("reach_id", "node_id", r("x", 4).alias("x"), r("y", 4).alias("y"))


@query()
def centerline_refinement(spark, sf_dir):
    """Refinement with smoothing until the nodes move by less than a metre, in four moves at most."""
    return refine.refine_centerlines(*_bank(spark, sf_dir), rounds=4, alpha=0.8)
