"""Pixels to reaches in two passes. Lineitems stand in for pixels around the reaches of their suppliers, ten of which lie in a row."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import two_pass
from . import river_tile
from .catalogue import c, query, r, table

_SCENE = """rk as (select s_suppkey as k, s_suppkey * 10 + 1 + s_suppkey % 6 as reach_id, case when s_suppkey % 11 = 10 then 1 when s_suppkey % 7 = 6 then 3 else 8 end as m from supplier),
raw as (select k, reach_id, m, unnest(range(m)) as node_id from rk),
nodes as (select k, reach_id, m, node_id, k % 10 * 1500 + node_id * 200.0::double as nx, k // 10 * 1100.0 + case when k % 4 = 1 then node_id * 45.0 else 0 end as ny,
case when k % 4 = 1 then 200 / sqrt(42025.0::double) else 1 end as tx, case when k % 4 = 1 then 45 / sqrt(42025.0::double) else 0 end as ty,
k % 9 * 40.0 - 30 as width, case when (k + node_id) % 5 = 3 then null else 60.0 + k % 4 * 30 end as max_width, 0.5 + k % 3 * 0.25 as coef, 1.0 + k % 3 as ext from raw),
pix as (select (l_orderkey * 8 + l_linenumber) * 20000000 + floor(l_extendedprice * 100 + 0.5)::bigint as pixel_id, l_suppkey % 10 * 1500 + l_partkey * 37 % 2000 - 300 + l_quantity / 7 as x, l_suppkey // 10 * 1100 + l_extendedprice * 7 % 1500 - 700 as y,
case when l_partkey % 13 = 0 then 0 when l_partkey % 5 = 0 then l_suppkey + 2 else l_suppkey - l_suppkey % 3 + 1 end as label from lineitem)"""
_HALF = """w1 as (select *, case when width is null or max_width is null then null else greatest(width, max_width) end as wide from nodes), w2 as (select *, coalesce(wide, median(wide) over (partition by reach_id)) as w from w1),
w3 as (select *, case when w <= 0 then median(w) over (partition by reach_id) else w end * coef as half from w2)"""
_PASSES = """met as (select pixel_id, x, y, label, reach_id, min(struct_pack(d2 := (x - nx) * (x - nx) + (y - ny) * (y - ny), node_id := node_id)) as b from pix, w3 group by all),
near as (select pixel_id, label, met.reach_id, m, b.node_id as node_id, b.d2 as d2, (x - nx) * tx + (y - ny) * ty as s, (y - ny) * tx - (x - nx) * ty as n, half, ext from met join w3 on met.reach_id = w3.reach_id and b.node_id = w3.node_id),
k1 as (select reach_id, label, count(*) as c from near where abs(n) <= 300 and abs(s) <= 600 and label > 0 and m > 3 group by 1, 2), main1 as (select reach_id, label as main from k1 qualify row_number() over (partition by reach_id order by c desc, label) = 1),
nb as (select a.reach_id, b.reach_id as neighbour from rk a join rk b on a.k // 10 = b.k // 10 and abs(a.k - b.k) = 1),
ren as (select distinct nb.reach_id, o.main as label, a.main as renamed from nb join main1 o on o.reach_id = nb.neighbour join main1 a on a.reach_id = nb.reach_id),
l2 as (select near.*, coalesce(renamed, near.label) as lab from near left join ren on ren.reach_id = near.reach_id and ren.label = near.label),
k2 as (select reach_id, lab, count(*) as c from l2 where abs(n) <= half and abs(s) <= 600 and lab > 0 group by 1, 2), main2 as (select reach_id, lab as main from k2 qualify row_number() over (partition by reach_id order by c desc, lab) = 1),
inn as (select l2.* from l2 join main2 using (reach_id) where (abs(n) <= half and abs(s) <= 600) or (lab = main and abs(n) <= 20 * greatest(200, half) and abs(s) <= 20 * greatest(200, half))),
tile as (select pixel_id, min(d2) as least from near group by 1), one as (select inn.* from inn join tile on inn.pixel_id = tile.pixel_id and d2 = least qualify row_number() over (partition by inn.pixel_id order by reach_id desc) = 1),
kept as (select * from one where reach_id % 10 <> 6 and m > 1), full1 as (select distinct reach_id from (select reach_id, node_id from kept group by 1, 2 having count(*) >= 10)), pop as (select kept.* from kept join full1 using (reach_id))"""
_OUT = "select pixel_id, reach_id, node_id, round(sqrt(d2), 4) as d, round(s, 4) as s, round(n, 4) as n from"


def scene(spark, sf_dir):
    """Pixels, nodes and neighbours."""
    k, node = c("k"), c("node_id")
    rk = table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("k"), (c("s_suppkey") * 10 + 1 + c("s_suppkey") % 6).alias("reach_id"))
    m = F.when(k % 11 == 10, 1).when(k % 7 == 6, 3).otherwise(8)
    nodes = rk.select("k", "reach_id", F.explode(F.sequence(F.lit(0).cast("long"), (m - 1).cast("long"))).alias("node_id"))
    bent = k % 4 == 1
    nodes = nodes.select(
        "reach_id", "node_id", (k % 10 * 1500 + node * 200.0).alias("x"), (F.floor(k / 10) * 1100.0 + F.when(bent, node * 45.0).otherwise(0.0)).alias("y"),
        F.when(bent, 200 / F.sqrt(F.lit(42025.0))).otherwise(1.0).alias("tx"), F.when(bent, 45 / F.sqrt(F.lit(42025.0))).otherwise(0.0).alias("ty"), F.lit(200.0).alias("spacing"),
        (k % 9 * 40.0 - 30).alias("width"), F.when((k + node) % 5 == 3, None).otherwise(60.0 + k % 4 * 30).alias("max_width"), (0.5 + k % 3 * 0.25).alias("wth_coef"), (1.0 + k % 3).alias("ext_dist_coef"),
    )
    a, b = rk.withColumn("row", F.floor(k / 10)), rk.select(F.floor(k / 10).alias("row"), k.alias("k2"), c("reach_id").alias("neighbour"))
    neighbours = a.join(b.hint("merge"), "row").where(F.abs(k - c("k2")) == 1).select("reach_id", "neighbour")
    sup, part = c("l_suppkey"), c("l_partkey")
    label = F.when(part % 13 == 0, 0).when(part % 5 == 0, sup + 2).otherwise(sup - sup % 3 + 1)
    x, y = sup % 10 * 1500 + part * 37 % 2000 - 300 + c("l_quantity") / 7, F.floor(sup / 10) * 1100 + c("l_extendedprice") * 7 % 1500 - 700
    pixels = table(spark, sf_dir, "lineitem").select(((c("l_orderkey") * 8 + c("l_linenumber")) * 20000000 + F.floor(c("l_extendedprice") * 100 + 0.5)).alias("pixel_id"), x.alias("x"), y.alias("y"), label.alias("label"))
    return pixels, nodes, neighbours


def _rounded(rows):
    return rows.select("pixel_id", "reach_id", "node_id", *(r(k, 4).alias(k) for k in "dsn"))


@query(f"with {_SCENE}, {_HALF}, {_PASSES} {_OUT} pop")
def two_pass_assignment(spark, sf_dir):
    return _rounded(two_pass.assign_reaches(*scene(spark, sf_dir)))


@query(f"""with {_SCENE}, {_HALF}, {_PASSES}, ext as (select * from pop where abs(s) <= ext * greatest(200, half) and abs(n) <= ext * greatest(200, half)),
full2 as (select distinct reach_id from (select reach_id, node_id from ext group by 1, 2 having count(*) >= 10)) {_OUT} ext join full2 using (reach_id)""")
def two_pass_ext_dist(spark, sf_dir):
    return _rounded(two_pass.assign_reaches(*scene(spark, sf_dir), use_ext_dist_coef=True))


@query(f"with {_SCENE}, {_HALF} select reach_id, node_id, round(half, 5) as half_width from w3")
def search_widths(spark, sf_dir):
    return two_pass.search_widths(scene(spark, sf_dir)[1]).select("reach_id", "node_id", r("half_width").alias("half_width"))


def tile(spark, sf_dir):
    """The scene's assigned pixels with their measurements, and its prior nodes."""
    pixels, nodes, neighbours = scene(spark, sf_dir)
    pixel_id = (c("l_orderkey") * 8 + c("l_linenumber")) * 20000000 + F.floor(c("l_extendedprice") * 100 + 0.5)
    measured = table(spark, sf_dir, "lineitem").select(
        pixel_id.alias("pixel_id"), (c("l_extendedprice") / 9970 + 30).alias("height"), (0.1 + c("l_tax")).alias("sigma"), c("l_linenumber").alias("klass"), (c("l_discount") * 10).alias("water_frac"), (c("l_quantity") * 20).alias("pixel_area"), (c("l_returnflag") == "A").alias("degraded")
    )
    return two_pass.assign_reaches(pixels, nodes, neighbours).join(measured, "pixel_id"), nodes.select("reach_id", "node_id", c("spacing").alias("node_length"))


@query(f"""with {_SCENE}, {_HALF}, {_PASSES}, att as (select (l_orderkey * 8 + l_linenumber) * 20000000 + floor(l_extendedprice * 100 + 0.5)::bigint as pixel_id, l_extendedprice / 9970 + 30 as h, 0.1 + l_tax as sg, l_linenumber as klass, l_discount * 10 as wf, l_quantity * 20 as pa, l_returnflag = 'A' as bad from lineitem),
t as (select reach_id, node_id, att.*, klass in (3, 4, 6, 7) and not bad as good from pop join att using (pixel_id)), g as (select reach_id, node_id, count(*) as n_pix, count(*) filter (where good) as n_good, sum(h / (sg * sg)) filter (where good) / sum(1 / (sg * sg)) filter (where good) as hg, sum(h / (sg * sg)) / sum(1 / (sg * sg)) as ha,
1 / sqrt(sum(1 / (sg * sg))) as u, sum(case when klass in (4, 6, 7, 5) then pa when klass in (2, 3) then pa * greatest(least(wf, 3), -3) else 0 end) as area from t group by 1, 2)
select reach_id, node_id, n_pix, n_good, round(case when n_good >= 3 then hg else ha end, 5) as wse, round(u, 6) as wse_u, round(area, 4) as area, ((n_good < 3)::bigint * 2048 + (n_good = 0)::bigint * 262144)::bigint as node_flag from g""")
def river_tile_nodes(spark, sf_dir):
    """Nodes of the scene, from pixels assigned in two passes."""
    out = river_tile.nodes(tile(spark, sf_dir)[0])
    return out.select("reach_id", "node_id", "n_pix", "n_good", r("wse").alias("wse"), r("wse_u", 6).alias("wse_u"), r("area", 4).alias("area"), "node_flag")


def river_tile_reaches(spark, sf_dir):
    """The chain from pixels to reaches: two passes, nodes, outliers, the fitted line, every prior reach."""
    assigned, prior = tile(spark, sf_dir)
    return river_tile.reaches(river_tile.nodes(assigned), prior)
