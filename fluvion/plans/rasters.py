"""Queries on rasters of labels. Parts stand in for a raster's rows, suppliers for its columns; a lineitem is a pixel."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import labels
from .catalogue import c, query, r, table

# a join on each of the four steps, which can be hashed
_STEPS = """{name}(az, rg, oaz, org) as (select az, rg, az, rg from {cells} union select f.az, f.rg, m.az, m.rg from (select az, rg, oaz + unnest([0, 0, 1, -1]) as oaz, org + unnest([1, -1, 0, 0]) as org from {name}) f join {cells} m on m.az = f.oaz and m.rg = f.org)"""
_PIXELS = "pix as (select l_partkey as az, l_suppkey as rg, max(l_quantity) > 12 as is_water from lineitem group by 1, 2), water as (select az, rg from pix where is_water)"
_MASK = "mask as (select l_partkey // 8 as az, l_suppkey // 2 as rg from lineitem group by 1, 2 having sum(l_quantity) >= $Q)"


def _numbered(name: str, flood: str) -> str:
    return f"{name} as (select az, rg, dense_rank() over (order by part) as label from (select az, rg, min(oaz * 100000 + org) as part from {flood} group by 1, 2))"


def _raster(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(c("l_partkey").alias("az"), c("l_suppkey").alias("rg")).agg((F.max("l_quantity") > 12).alias("is_water"))


def _mask(spark, sf_dir, least):
    cells = table(spark, sf_dir, "lineitem").groupBy(F.floor(c("l_partkey") / 8).alias("az"), F.floor(c("l_suppkey") / 2).alias("rg"))
    return cells.agg(F.sum("l_quantity").alias("q")).where(c("q") >= least).select("az", "rg")


@query(f"with recursive {_MASK.replace('$Q', '125')}, {_STEPS.format(name='flood', cells='mask')}, {_numbered('found', 'flood')} select az, rg, label from found")
def segment_components(spark, sf_dir):
    """4-connected components of the whole raster, numbered in scan order."""
    parts = labels.components(_mask(spark, sf_dir, 125))
    return parts.join(labels.numbered(parts), "part").select("az", "rg", c("number").alias("label"))


@query(f"""with recursive {_PIXELS}, {_STEPS.format(name='flood', cells='water')}, {_numbered('found', 'flood')},
near as (select p.az, p.rg, max(label) as near from (select az, rg, az + unnest([-1, -1, -1, 0, 0, 1, 1, 1]) as oaz, rg + unnest([-1, 0, 1, -1, 1, -1, 0, 1]) as org from pix where not is_water) p join found f on f.az = oaz and f.rg = org group by 1, 2)
select pix.az, pix.rg, coalesce(label, near, 0) as label from pix left join found using (az, rg) left join near using (az, rg)""")
def water_labels(spark, sf_dir):
    """Labels of water pixels; the others take the largest one around."""
    return labels.water_labels(_raster(spark, sf_dir))


@query(f"""with recursive {_MASK.replace('$Q', '70')}, er as (select az, rg from (select az + unnest([0, 0, 0, 1, -1]) as az, rg + unnest([0, 1, -1, 0, 0]) as rg from mask) group by 1, 2 having count(*) = 5),
{_STEPS.format(name='flood', cells='er')}, {_numbered('first', 'flood')}, step as (select i, j from range(-2, 3) a(i), range(-2, 3) b(j)),
bare as (select * from mask anti join first using (az, rg)), taken as (select b.az, b.rg, max(label) as label from (select az, rg, az + i as oaz, rg + j as org from bare, step) b join first f on f.az = oaz and f.rg = org group by 1, 2),
labelled as (select * from first union all select * from taken), orphans as (select * from mask anti join labelled using (az, rg)),
grown as (select distinct az, rg from (select az + unnest([0, 0, 0, 1, -1]) as az, rg + unnest([0, 1, -1, 0, 0]) as rg from orphans) where az >= 0 and rg >= 0),
{_STEPS.format(name='flood2', cells='grown')}, {_numbered('parts', 'flood2')}, touched as (select p.label as part, l.label as own, count(*) as n from parts p join labelled l using (az, rg) group by 1, 2 qualify row_number() over (partition by p.label order by n desc, own) = 1),
given as (select az, rg, coalesce(own, label + (select coalesce(max(label), 0) from first)) as given from parts left join touched on part = label)
select az, rg, coalesce(given, label) as label from mask left join labelled using (az, rg) left join given using (az, rg)""")
def erosion_labels(spark, sf_dir):
    """Labels of what erosion leaves, given back to what it took; what vanished is reattached or has labels of its own."""
    return labels.eroded_labels(_mask(spark, sf_dir, 70), 1)


_NODES = "nodes as (select s_suppkey as reach_id, unnest(range(6)) as node_id, s_suppkey * 17 % 2000 * 1.0 + node_id * 20 as x, s_suppkey * 29 % 100 * 25.0 + node_id % 2 * 30 as y from supplier)"


@query(f"""with p as (select o_custkey % 60 + 1 as label, o_custkey * 7 % 2100 + o_totalprice % 50 as x, o_custkey * 11 % 2600 + o_totalprice % 70 as y from orders), {_NODES},
sized as (select label, count(*) as size from p group by 1 having count(*) >= 30), d as (select reach_id, node_id, label, sqrt(min((p.x - n.x) * (p.x - n.x) + (p.y - n.y) * (p.y - n.y))) as d from nodes n, p semi join sized using (label) group by 1, 2, 3),
m as (select reach_id, label, avg(d) as distance from d group by 1, 2) select reach_id, label, round(distance, 4) as distance from m join sized using (label) qualify row_number() over (partition by reach_id order by round(distance, 9), size desc, label) = 1""")
def reach_labels(spark, sf_dir):
    """The label nearest to each supplier's reach; customers' orders stand in for labelled pixels."""
    k, price = c("o_custkey"), c("o_totalprice")
    pixels = table(spark, sf_dir, "orders").select((k % 60 + 1).alias("label"), (k * 7 % 2100 + price % 50).alias("x"), (k * 11 % 2600 + price % 70).alias("y"))
    s, node = c("s_suppkey"), c("node_id")
    nodes = table(spark, sf_dir, "supplier").select(s.alias("reach_id"), F.explode(F.sequence(F.lit(0), F.lit(5))).alias("node_id"))
    nodes = nodes.select("reach_id", "node_id", (c("reach_id") * 17 % 2000 * 1.0 + node * 20).alias("x"), (c("reach_id") * 29 % 100 * 25.0 + node % 2 * 30).alias("y"))
    return labels.labels_of_reaches(pixels, nodes, cell=64.0, min_pixels=30, max_pixels=None).withColumn("distance", r("distance", 4))
