"""Catalogue queries that score products: errors, distributions, overlays and checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import quality
from ..operators import metrics, quantiles
from .catalogue import c, node_rows, pixels, query, r, table


def sides(spark, sf_dir, *key):
    """Truth (side F) and data (side O) of each key."""
    p = pixels(spark, sf_dir).groupBy(*key)
    of = lambda s, f: f(F.when(c("side") == s, c("area" if f is F.sum else "h")))
    return p.agg(of("F", F.sum).alias("t_area"), of("O", F.sum).alias("d_area"), of("F", F.avg).alias("t_wse"), of("O", F.avg).alias("d_wse"))


_SIDES = """s as (select reach, node, sum(area) filter (where side = 'F') as t_area, sum(area) filter (where side = 'O') as d_area,
avg(h) filter (where side = 'F') as t_wse, avg(h) filter (where side = 'O') as d_wse from pix group by 1, 2)"""
_REACH = _SIDES.replace("reach, node,", "reach,").replace("group by 1, 2", "group by 1")


@query("with $PIX select reach, node, round(avg(h), 5) as sig0, round(stddev_pop(h), 5) as sig0_std, round(sqrt(sum(sigma * sigma)) / count(*), 5) as sig0_u from pix group by 1, 2")
def sigma0_agg(spark, sf_dir):
    p = pixels(spark, sf_dir).groupBy("reach", "node")
    return p.agg(r(F.avg("h")).alias("sig0"), r(F.stddev_pop("h")).alias("sig0_std"), r(F.sqrt(F.sum(c("sigma") * c("sigma"))) / F.count("*")).alias("sig0_u"))


@query("""with $PIX, b as (select least(floor(area / 5)::int + 1, 10) as bin, h from pix where area between 0 and 50)
select bin, count(*) as n, round(quantile_cont(h, 0.16), 5) as p16, round(quantile_cont(h, 0.5), 5) as p50, round(quantile_cont(h, 0.84), 5) as p84 from b group by 1""")
def binned_percentiles(spark, sf_dir):
    b = pixels(spark, sf_dir).select(metrics.bin_of(c("area"), 0.0, 50.0, 10).alias("bin"), "h").where("bin is not null")
    found = quantiles.percentiles(b, ["bin"], "h", {"p16": 0.16, "p50": 0.5, "p84": 0.84})
    return found.select("bin", "n", *(r(k).alias(k) for k in ("p16", "p50", "p84")))


@query("""with $PIX, q as (select klass, quantile_cont(h, 0.01) as lo, quantile_cont(h, 0.99) as hi, avg(h) as mean, median(h) as mid, stddev_pop(h) as std from pix group by 1)
select klass, round(mean, 5) as mean, round(mid, 5) as mid, round(std, 5) as std, floor(h / 5)::int as bin, count(*) as n from pix join q using (klass) where h between lo and hi group by 1, 2, 3, 4, 5""")
def class_histogram(spark, sf_dir):
    p = pixels(spark, sf_dir).select("klass", "h")
    marks = quantiles.percentiles(p, ["klass"], "h", {"lo": 0.01, "hi": 0.99, "mid": 0.5}).select("klass", "lo", "hi", r("mid").alias("mid"))
    q = p.groupBy("klass").agg(r(F.avg("h")).alias("mean"), r(F.stddev_pop("h")).alias("std")).join(marks, "klass")
    inside = p.join(q, "klass").where(c("h").between(c("lo"), c("hi")))
    return inside.groupBy("klass", "mean", "mid", "std", F.floor(c("h") / 5).cast("int").alias("bin")).agg(F.count("*").alias("n"))


@query("""with $NODES, f as (select reach, regr_slope(wse, node) as a, regr_intercept(wse, node) as b from nodes group by 1)
select reach, round(max(abs(wse - a * node - b)) * 100, 3) as error from nodes join f using (reach) group by 1""")
def line_fit_error(spark, sf_dir):
    return metrics.line_error(node_rows(spark, sf_dir), ["reach"], "node", "wse").select("reach", r("error", 3).alias("error"))


@query(f"""with $PIX, {_SIDES}, e as (select reach % 4 as kind, reach, node, abs(d_wse - t_wse) as e from s where d_wse - t_wse is not null)
select reach, node, kind, round(row_number() over w / count(*) over (partition by kind)::double, 6) as share from e window w as (partition by kind order by e, reach, node)""")
def ecdf_by_class(spark, sf_dir):
    e = sides(spark, sf_dir, "reach", "node").withColumn("kind", c("reach") % 4).withColumn("e", F.abs(c("d_wse") - c("t_wse"))).where("e is not null")
    return metrics.ranked_share(e, ["kind"], "e", ["reach", "node"], 0.1).select("reach", "node", "kind", r("share", 6).alias("share"))


@query(f"""with $PIX, {_REACH}, m as (select reach, (d_area - t_area) / nullif(t_area, 0) * 100 as area_e, (d_wse - t_wse) * 100 as wse_e from s)
select reach, round(area_e, 5) as area_e, round(wse_e, 4) as wse_e, case when abs(area_e) <= 15 then 'pass' when abs(area_e) <= 30 then 'between' when abs(area_e) > 30 then 'fail' end as area_v,
case when abs(wse_e) <= 10 then 'pass' when abs(wse_e) <= 20 then 'between' when abs(wse_e) > 20 then 'fail' end as wse_v from m""")
def reach_metrics(spark, sf_dir):
    m = sides(spark, sf_dir, "reach").select("reach", metrics.share(c("d_area"), c("t_area")).alias("area_e"), ((c("d_wse") - c("t_wse")) * 100).alias("wse_e"))
    return m.select("reach", r("area_e").alias("area_e"), r("wse_e", 4).alias("wse_e"), metrics.verdict(c("area_e"), "area").alias("area_v"), metrics.verdict(c("wse_e"), "wse").alias("wse_v"))


@query(f"""with $PIX, {_SIDES}, m as (select reach, node, (d_area - t_area) / nullif(d_area, 0) * 100 as area_e, (d_wse - t_wse) * 100 as wse_e from s)
select reach, node, round(area_e, 5) as area_e, round(wse_e, 4) as wse_e from m where abs(wse_e) < 3000 and abs(area_e) < 999""")
def node_metrics(spark, sf_dir):
    m = sides(spark, sf_dir, "reach", "node").select("reach", "node", (-metrics.share(c("t_area"), c("d_area"))).alias("area_e"), ((c("d_wse") - c("t_wse")) * 100).alias("wse_e"))
    return m.where((F.abs("wse_e") < 3000) & (F.abs("area_e") < 999)).select("reach", "node", r("area_e").alias("area_e"), r("wse_e", 4).alias("wse_e"))


@query(f"""with $PIX, {_SIDES} select reach, node, case when t_area + d_area is not null and t_wse + d_wse is not null then round(t_area, 5) end as t_area,
case when t_area + d_area is not null and t_wse + d_wse is not null then round(d_wse, 5) end as d_wse from s""")
def masked_metrics(spark, sf_dir):
    s = sides(spark, sf_dir, "reach", "node")
    t_area, _, _, d_wse = metrics.all_or_null(*map(c, ("t_area", "d_area", "t_wse", "d_wse")))
    return s.select("reach", "node", r(t_area).alias("t_area"), r(d_wse).alias("d_wse"))


@query(f"""with $PIX, {_SIDES}, e as (select reach, abs(d_wse - t_wse) * 100 as e from s where d_wse - t_wse is not null)
select reach, round(quantile_cont(e, 0.68), 4) as p68, round(median(e), 4) as p50, round(avg(case when e <= 1000 then 100.0 else 0 end), 5) as within from e group by 1""")
def requirement_share(spark, sf_dir):
    e = sides(spark, sf_dir, "reach", "node").select("reach", (F.abs(c("d_wse") - c("t_wse")) * 100).alias("e")).where("e is not null")
    return e.groupBy("reach").agg(r(F.percentile("e", F.lit(0.68)), 4).alias("p68"), r(F.median("e"), 4).alias("p50"), r(F.avg(F.when(c("e") <= 1000, 100.0).otherwise(0.0))).alias("within"))


@query("""with $PIX, t as (select distinct reach as az, node as rg, 1 as k from pix where side = 'F' and klass = 1), d as (select distinct reach as az, node as rg, 2 as k from pix where side = 'O' and klass = 1)
select az, rg, d.k as data, t.k as truth, case when d.k is null then 'miss' when t.k is null then 'false' else 'hit' end as kind from d full join t using (az, rg)""")
def slant_plane_overlay(spark, sf_dir):
    p = pixels(spark, sf_dir).where("klass = 1").select("side", c("reach").alias("az"), c("node").alias("rg")).distinct()
    return metrics.overlay(p.where("side = 'O'").withColumn("k", F.lit(2)), p.where("side = 'F'").withColumn("k", F.lit(1)), ["az", "rg"], "k")


@query("""with $NODES select a.reach, a.node, round(median(b.wse), 5) as wse from nodes a join nodes b on abs(a.reach - b.reach) <= 2 and abs(a.node - b.node) <= 2 group by 1, 2""")
def median_filter(spark, sf_dir):
    return metrics.median_filter(node_rows(spark, sf_dir), [], "reach", "node", "wse", 2).select("reach", "node", r("wse").alias("wse"))


@query("""with e as (select event_type, epoch_us(ts) as t, value, event_id from events), k as (select event_type, t // 3600000000 as hour, min(t) as t from e group by 1, 2),
n as (select event_type, t, row_number() over (partition by event_type order by t) - 1 as n from k), p as (select e.event_id, e.event_type, e.t, n.t as lo, n.n from e asof join n on e.event_type = n.event_type and e.t >= n.t),
q as (select p.*, h.t as hi, h.n as m from p join n h on h.event_type = p.event_type and h.n = p.n + case when p.t = p.lo then 0 else 1 end)
select event_id, round_even(n + coalesce((t - lo) / nullif(hi - lo, 0)::double, 0) * (m - n), 0)::bigint as record from q
union all select event_id, null from p where t > lo and not exists (select 1 from n h where h.event_type = p.event_type and h.n = p.n + 1)""")
def sensor_index(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.unix_micros(c("ts").cast("timestamp")).alias("t"))
    k = e.groupBy("event_type", F.floor(c("t") / 3600000000)).agg(F.min("t").alias("t")).select("event_type", "t")
    n = k.withColumn("record", F.row_number().over(Window.partitionBy("event_type").orderBy("t")) - 1)
    return metrics.record_number(e, n, ["event_type"], "t", "record", stretch=86400e6).select("event_id", "record")


@query("""with $NODES select reach, node, case when n >= 20 then 'linear' when area > 600 then 'multi_chn' when wse > 45 then 'bad' when wse < 25 then 'edge' else 'other' end as category from nodes""")
def truth_category(spark, sf_dir):
    kind = F.when(c("n") >= 20, "linear").when(c("area") > 600, "multi_chn").when(c("wse") > 45, "bad").when(c("wse") < 25, "edge").otherwise("other")
    return node_rows(spark, sf_dir).select("reach", "node", kind.alias("category"))


@query("""with $NODES, f as (select (case when n < 5 then 1024 else 0 end + case when wse > 40 then 16777216 else 0 end)::bigint as flag, case when wse > 41 then 3 when n < 5 then 1 else 0 end as q from nodes)
select q, case when flag = 0 then 0 when flag < 262144 then 1 when flag < 4194304 then 2 else 3 end as expected, count(*) as n from f where q <> (case when flag = 0 then 0 when flag < 262144 then 1 when flag < 4194304 then 2 else 3 end) group by 1, 2""")
def summary_flag_check(spark, sf_dir):
    f = node_rows(spark, sf_dir).select(quality.summary(quality.flag({"few_wse": c("n") < 5, "wse_bad": c("wse") > 40})).alias("expected"), F.when(c("wse") > 41, 3).when(c("n") < 5, 1).otherwise(0).alias("q"))
    return f.where("q <> expected").groupBy("q", "expected").agg(F.count("*").alias("n"))


@query("""with $NODES, m as (select reach, regr_slope(wse, node) as a, avg(wse) as b, avg(node) as mid from nodes group by 1) select reach, node, round(wse - (b + a * (node - mid)), 5) as residual from nodes join m using (reach)""")
def node_fit_residuals(spark, sf_dir):
    n = node_rows(spark, sf_dir)
    m = n.groupBy("reach").agg(F.regr_slope("wse", "node").alias("a"), F.avg("wse").alias("b"), F.avg("node").alias("mid"))
    return n.join(m, "reach").select("reach", "node", r(c("wse") - (c("b") + c("a") * (c("node") - c("mid")))).alias("residual"))
