"""Queries on the network of reaches. Suppliers stand in for reaches: 25 lines of them, one behind the other, some the other way round."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fits, network
from .catalogue import c, node_rows, query, r, table

#: ids end in a type from 1 to 6; the next reach upstream is 25 on, the second neighbour in the lists lies elsewhere.
_ID = "({k} * 10 + 1 + {k} % 6)"
_REACHES = f"""rk as (select s_suppkey as k, {_ID.format(k="s_suppkey")} as reach_id, [{_ID.format(k="(s_suppkey + 7)")}, {_ID.format(k="(s_suppkey + 25)")}] as a,
[case when s_suppkey >= 25 then {_ID.format(k="(s_suppkey - 25)")} else 0 end, 0] as b from supplier),
reaches as (select k, reach_id, case when k % 5 = 0 then b when k % 3 = 0 then a else a[2:] end as up, case when k % 5 = 0 then a else b end as down from rk),
prior as (select k, reach_id, unnest(range(50)) as node_id from reaches), placed as (select *, (k // 25 * 50 + node_id) * 200.0::double as x, k % 25 * 5000.0 + case when k % 4 = 0 then 250 else 0 end as y, node_id * 200.0 + 100 as s from prior)"""


def _id(k):
    return k * 10 + 1 + k % 6


def _reaches(spark, sf_dir):
    k = c("s_suppkey")
    far, near, behind = _id(k + 7), _id(k + 25), F.when(k >= 25, _id(k - 25)).otherwise(0)
    a, short, b = F.array(far, near), F.array(near), F.array(behind, F.lit(0).cast("long"))
    up = F.when(k % 5 == 0, b).when(k % 3 == 0, a).otherwise(short)
    return table(spark, sf_dir, "supplier").select(k.alias("k"), _id(k).alias("reach_id"), up.alias("up"), F.when(k % 5 == 0, a).otherwise(b).alias("down"))


def _prior(spark, sf_dir):
    nodes = _reaches(spark, sf_dir).select("k", "reach_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(49).cast("long"))).alias("node_id"))
    x, y = (F.floor(c("k") / 25) * 50 + c("node_id")) * 200.0, c("k") % 25 * 5000.0 + F.when(c("k") % 4 == 0, 250).otherwise(0)
    return nodes.select("reach_id", "node_id", x.alias("x"), y.alias("y"), (c("node_id") * 200.0 + 100).alias("s"))


def _observed(spark, sf_dir):
    return node_rows(spark, sf_dir).where("n >= 4").select(_id(c("reach")).alias("reach_id"), c("node").alias("node_id"), (c("n") % 4).alias("node_q"), "wse", (1 / F.sqrt("n")).alias("wse_u"))


_OBSERVED = f"seen as (select {_ID.format(k='reach')} as reach_id, node as node_id, n % 4 as node_q, wse from nodes where n >= 4)"
_CONTINUED = """fair as (select reach_id from seen group by 1 having count(*) filter (where node_q < 3) > 5),
tries as (select reach_id, 0 as turn, list_filter(down, lambda i: i <> 0 and i % 10 not in (3, 4, 5))[1] as other from reaches union all select reach_id, 1, list_filter(up, lambda i: i <> 0 and i % 10 not in (3, 4, 5))[1] from reaches),
ends as (select reach_id, arg_min(x, node_id) as fx, arg_min(y, node_id) as fy, arg_max(x, node_id) as lx, arg_max(y, node_id) as ly, max(s) as long from placed group by 1),
apart as (select t.*, sqrt(pow(o.lx - e.fx, 2) + pow(o.ly - e.fy, 2)) as behind, sqrt(pow(o.fx - e.lx, 2) + pow(o.fy - e.ly, 2)) as ahead from tries t join fair on fair.reach_id = t.other join ends e on e.reach_id = t.reach_id join ends o on o.reach_id = t.other),
sides as (select reach_id, -1 as side, arg_max(other, turn) as other from apart where behind < 300 group by 1 union all select reach_id, 1, arg_max(other, turn) from apart where ahead < 300 group by 1)"""


@query(f"with $NODES, {_REACHES}, {_OBSERVED}, {_CONTINUED} select reach_id, side, other from sides")
def reach_continuations(spark, sf_dir):
    return network.neighbours(_reaches(spark, sf_dir), _prior(spark, sf_dir), _observed(spark, sf_dir))


@query(f"""with $NODES, {_REACHES}, {_OBSERVED}, {_CONTINUED}, down as (select s.reach_id, long as down from sides s join ends e on e.reach_id = s.other where side = -1),
parts as (select reach_id, side as part, other from sides union all select reach_id, 0, reach_id from reaches)
select p.reach_id, part, p.other, n.node_id, case part when -1 then 0 when 0 then coalesce(down, 0) else coalesce(down, 0) + long end + n.s as ss, node_q, round(wse, 5) as wse
from parts p join ends e on e.reach_id = p.reach_id left join down d on d.reach_id = p.reach_id join placed n on n.reach_id = p.other left join seen q on q.reach_id = n.reach_id and q.node_id = n.node_id
where part = 0 or wse is not null""")
def stitched_reaches(spark, sf_dir):
    out = network.stitched(_reaches(spark, sf_dir), _prior(spark, sf_dir), _observed(spark, sf_dir).drop("wse_u"))
    return out.withColumn("wse", r("wse"))


@query()
def stitched_enhanced_slope(spark, sf_dir):
    """Enhanced slopes over the reach and those that continue it."""
    rows = network.stitched(_reaches(spark, sf_dir), _prior(spark, sf_dir), _observed(spark, sf_dir), all_nodes=False)
    return fits.enhanced_slope(rows.where("node_q < 3").select("reach_id", c("ss").alias("s"), "wse", "wse_u"))


_VERTICES = """v as (select p_partkey as cl_id, p_partkey * 30.0::double as x, (p_size % 3) * 1.0::double as y, [p_partkey // 20 + 1, case when p_partkey % 20 in (0, 19) then p_partkey // 20 + case when p_partkey % 20 = 0 then 0 else 2 end else 0 end,
case when p_size = 7 then p_partkey // 20 + 3 else 0 end, case when p_size = 9 then p_partkey // 20 + 1 else 0 end] as reach_ids from part)"""


def _centerlines(spark, sf_dir):
    k, size = c("p_partkey"), c("p_size")
    line, place = F.floor(k / 20), k % 20
    ids = F.array(line + 1, F.when(place == 0, line).when(place == 19, line + 2).otherwise(0), F.when(size == 7, line + 3).otherwise(0), F.when(size == 9, line + 1).otherwise(0))
    return table(spark, sf_dir, "part").select(k.alias("cl_id"), (k * 30.0).alias("x"), (size % 3 * 1.0).alias("y"), ids.alias("reach_ids"))


@query(f"with {_VERTICES}, e as (select cl_id, x, y, unnest(reach_ids) as reach_id, generate_subscripts(reach_ids, 1) as place from v) select reach_id, cl_id, any_value(x) as x, any_value(y) as y, max(place) > 1 as is_extra from e where reach_id <> 0 group by 1, 2")
def centerline_lookup(spark, sf_dir):
    """Vertices of each of a line's reaches; the ends are shared with the neighbours, some vertices with others or twice with their own."""
    return network.vertices_of(_centerlines(spark, sf_dir))


# a reach's own 20 vertices lie 30 m apart; its neighbours' end vertices are the only extra ones within 50 m, one at either end
@query(f"""with {_VERTICES}, e as (select cl_id, x, y, unnest(reach_ids[:3]) as reach_id, generate_subscripts(reach_ids[:3], 1) as place from v), m as (select reach_id, cl_id, any_value(x) as x, any_value(y) as y, max(place) > 1 as is_extra from e where reach_id <> 0 group by 1, 2),
o as (select reach_id, min(cl_id) as lo, max(cl_id) as hi from m where not is_extra group by 1), k as (select m.* from m join o using (reach_id) where not is_extra or cl_id in (lo - 1, hi + 1))
select reach_id, row_number() over (partition by reach_id order by cl_id) - 1 as seq, cl_id, x, y from k join (select reach_id from o) using (reach_id)""")
def shared_end_vertices(spark, sf_dir):
    """Centerlines with the neighbours' end vertices; extra vertices elsewhere are left out."""
    lines = _centerlines(spark, sf_dir)
    return network.with_shared_ends(network.vertices_of(lines.withColumn("reach_ids", F.slice("reach_ids", 1, 3))))
