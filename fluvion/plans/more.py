"""More catalogue queries: assignment, geometry and matching."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import assign, discharge, joins
from .catalogue import c, node_rows, pixels, query, r, table


@query("""with v as (select p_partkey as k, p_partkey // 50 as line, p_partkey % 50 * 10.0 as x, p_size * 2.0 as y from part),
w as (select k, line, x, y, unnest([1,1,1,2,2,2,3,3,3]) as a, unnest([1,2,3,1,2,3,1,2,3]) as b from v),
t as (select w.k, w.x, w.y, p.x as px, p.y as py, q.x as qx, q.y as qy from w join v p on p.k = w.k - a and p.line = w.line join v q on q.k = w.k + b and q.line = w.line),
s as (select k, (x - px) * (qy - py) - (y - py) * (qx - px) as d, sqrt(pow(x - px, 2) + pow(y - py, 2)) * sqrt(pow(qx - x, 2) + pow(qy - y, 2)) * sqrt(pow(qx - px, 2) + pow(qy - py, 2)) as m from t),
best as (select k, min(abs(m / (2 * d))) as size from s where d <> 0 group by 1)
select v.k, round(size, 4) as blocking from v left join best using (k)""")
def blocking_width(spark, sf_dir):
    v = table(spark, sf_dir, "part").select(c("p_partkey").alias("k"), F.floor(c("p_partkey") / 50).alias("line"), (c("p_partkey") % 50 * 10.0).alias("x"), (c("p_size") * 2.0).alias("y"))
    return assign.blocking_width(v, ["line"], "k").select("k", r(F.abs("blocking"), 4).alias("blocking"))


@query("""with $PIX, m as (select reach, var_pop(h) as xx, var_pop(area) as yy, covar_pop(h, area) as xy, covar_pop(h, frac) as xz, covar_pop(area, frac) as yz from pix group by 1),
g as (select reach, (xz * yy - yz * xy) / nullif(xx * yy - xy * xy, 0) as gx, (yz * xx - xz * xy) / nullif(xx * yy - xy * xy, 0) as gy from m)
select reach, round(degrees(atan2(gy, gx)) - 360 * floor(degrees(atan2(gy, gx)) / 360), 4) as angle from g""")
def flow_angle(spark, sf_dir):
    gx, gy = assign.flow_gradient(c("h"), c("area"), c("frac"))
    g = pixels(spark, sf_dir).groupBy("reach").agg(gx.alias("gx"), gy.alias("gy"))
    return g.select("reach", r(F.pmod(F.degrees(F.atan2("gy", "gx")), F.lit(360.0)), 4).alias("angle"))


@query("""with $PIX, b as (select reach, min(h) as x0, max(h) as x1, min(tax) as y0, max(tax) as y1 from pix where klass = 1 and node < 5 group by 1)
select reach, round(x0, 5) as x0, round(x1, 5) as x1 from b where x0 - 0.25 <= 20 and x1 + 0.25 >= 10 and y0 - 0.005 <= 0.03 and y1 + 0.005 >= 0.02""")
def reach_bbox_overlap(spark, sf_dir):
    b = pixels(spark, sf_dir).where("klass = 1 and node < 5").groupBy("reach").agg(F.min("h").alias("x0"), F.max("h").alias("x1"), F.min("tax").alias("y0"), F.max("tax").alias("y1"))
    near = (c("x0") - 0.25 <= 20) & (c("x1") + 0.25 >= 10) & (c("y0") - 0.005 <= 0.03) & (c("y1") + 0.005 >= 0.02)
    return b.where(near).select("reach", r("x0").alias("x0"), r("x1").alias("x1"))


@query("""with $PIX, p as (select *, frac * 10 - 50 as s, h - 50 as n, klass % 4 as label from pix), ch as (select *, abs(n) <= 20 and abs(s) <= 45 as inside, abs(n) <= 40 and abs(s) <= 48 as far from p),
k as (select reach, label, count(*) as m from ch where inside and label > 0 group by 1, 2), main as (select reach, label as main from k qualify row_number() over (partition by reach order by m desc, label) = 1)
select pixel, klass, label from ch join main using (reach) where inside or (far and label = main)""")
def label_extension(spark, sf_dir):
    p = pixels(spark, sf_dir).withColumn("s", c("frac") * 10 - 50).withColumn("n", c("h") - 50).withColumn("label", c("klass") % 4)
    inside, far = (F.abs("n") <= 20) & (F.abs("s") <= 45), (F.abs("n") <= 40) & (F.abs("s") <= 48)
    return assign.with_dominant_label(p, ["reach"], "label", inside, far).select("pixel", "klass", "label")


@query("""with $PIX, p as (select pixel, klass, reach, (node + reach) % 6 as label from pix), k as (select reach, label, count(*) as m from p where label > 0 group by 1, 2),
main as (select reach, label as own from k qualify row_number() over (partition by reach order by m desc, label) = 1),
near as (select distinct a.reach, m.own as label from main a join main m on m.reach in (a.reach - 1, a.reach + 1))
select pixel, klass, reach, case when near.label is not null then own else p.label end as label from p left join main using (reach) left join near on near.reach = p.reach and near.label = p.label""")
def neighbour_labels(spark, sf_dir):
    p = pixels(spark, sf_dir).select("pixel", "klass", "reach", ((c("node") + c("reach")) % 6).alias("label"))
    around = p.select("reach").distinct().select("reach", F.explode(F.array(c("reach") - 1, c("reach") + 1)).alias("neighbour"))
    return assign.exchanged_labels(p, around, "reach", "label").select("pixel", "klass", "reach", "label")


@query("""with $NODES, q as (select reach, avg(wse) as h, 900.0 + reach % 50 as m from nodes group by 1)
select reach, round((0.5 * (least(h, 33.0) * least(h, 33.0) - 400.0) + 10 * (least(h, 33.0) - 20.0))
 + case when h > 33 then 1.0 * (least(h, 36.0) * least(h, 36.0) - 1089.0) - 20 * (least(h, 36.0) - 33.0) else 0 end + case when h > 36 then 0.25 * (h * h - 1296.0) + 30 * (h - 36.0) else 0 end - m, 4) as d_area from q""")
def area_change(spark, sf_dir):
    q = node_rows(spark, sf_dir).groupBy("reach").agg(F.avg("wse").alias("h"))
    lines = [(F.lit(1.0), F.lit(10.0)), (F.lit(2.0), F.lit(-20.0)), (F.lit(0.5), F.lit(30.0))]
    return q.select("reach", r(discharge.area_change(c("h"), (F.lit(20.0), F.lit(33.0), F.lit(36.0)), lines, 900.0 + c("reach") % 50), 4).alias("d_area"))


@query("""with $NODES select reach, (case when sum(area) <= 9000 then 1 else 0 end + case when count(*) < 50 then 2 else 0 end + case when avg(wse) > 36 then 4 else 0 end + case when max(n) > 25 then 8 else 0 end)::bigint as bits from nodes group by 1""")
def discharge_bits(spark, sf_dir):
    g = node_rows(spark, sf_dir).groupBy("reach").agg(F.sum("area").alias("a"), F.count("*").alias("k"), F.avg("wse").alias("h"), F.max("n").alias("m"))
    return g.select("reach", discharge.bits(no_area=c("a") <= 9000, few=c("k") < 50, high=c("h") > 36, crowded=c("m") > 25).alias("bits"))


@query("""with $PIX, t as (select reach, node, sum(area) as area from pix where side = 'F' group by 1, 2), d as (select reach, node, sum(area) as area from pix where side = 'O' group by 1, 2),
tr as (select reach, sum(area) as area from t group by 1), dr as (select reach, sum(area) as area from d group by 1)
select reach, node, t.area as t_area, d.area as d_area, tr.area as t_reach, dr.area as d_reach from t join d using (reach, node) join tr using (reach) join dr using (reach)""")
def six_way_join(spark, sf_dir):
    p = pixels(spark, sf_dir)
    of = lambda s, *k: p.where(c("side") == s).groupBy(*k).agg(F.sum("area").alias(f"{'td'[s == 'O']}_{'reach' if len(k) == 1 else 'area'}"))
    return of("F", "reach", "node").join(of("O", "reach", "node"), ["reach", "node"]).join(of("F", "reach"), "reach").join(of("O", "reach"), "reach").select("reach", "node", "t_area", "d_area", "t_reach", "d_reach")


@query("""with $PIX, v as (select distinct reach, node from pix where klass = 1), x as (select distinct reach, node from pix where klass = 4)
select reach, node, row_number() over (partition by reach order by node) - 1 as pixc_index from v join x using (reach, node)""")
def pixel_index_match(spark, sf_dir):
    p = pixels(spark, sf_dir)
    both = p.where("klass = 1").select("reach", "node").distinct().join(p.where("klass = 4").select("reach", "node").distinct(), ["reach", "node"])
    return both.withColumn("pixc_index", F.row_number().over(Window.partitionBy("reach").orderBy("node")).cast("long") - 1)


@query("""with e as (select user_id, event_id, epoch_us(ts) as t, event_type from events), a as (select * from e where event_type = 'purchase'), b as (select * from e where event_type <> 'purchase')
select a.event_id, b.event_id as before from a asof join b on a.user_id = b.user_id and a.t >= b.t""")
def last_before(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.unix_micros(c("ts").cast("timestamp")).alias("t"), (c("event_type") == "purchase").alias("bought"))
    w = Window.partitionBy("user_id").orderBy("t", "bought").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = e.withColumn("before", F.last(F.when(~c("bought"), c("event_id")), True).over(w))
    return seen.where(c("bought") & c("before").isNotNull()).select("event_id", "before")


@query("""with $NODES select reach, node, round(wse, 5) as wse from nodes qualify row_number() over (partition by reach order by wse desc, node) <= 3""")
def top_nodes(spark, sf_dir):
    w = Window.partitionBy("reach").orderBy(c("wse").desc(), "node")
    return node_rows(spark, sf_dir).withColumn("k", F.row_number().over(w)).where("k <= 3").select("reach", "node", r("wse").alias("wse"))


@query("""with $PIX, l as (select reach, node, h from pix where klass = 5 qualify row_number() over (partition by reach, node order by pixel) = 1) select reach, node, round(h, 5) as h from l""")
def first_occurrence(spark, sf_dir):
    return joins.first_of(pixels(spark, sf_dir).where("klass = 5"), ["reach", "node"], ["pixel"]).select("reach", "node", r("h").alias("h"))
