"""Queries that complete, name and check products."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import completion, quantiles
from ..sources.scratch import written
from .catalogue import c, node_rows, pixels, query, r
from .network import _REACHES, _id, _prior, _reaches

_SEEN = "obs as (select reach * 10 + 1 + reach % 6 as reach_id, node as node_id, node * 200.0 + n as x, wse as y, n as n_good_pix, wse, (n % 4)::int as node_q, (n * 1024)::bigint as node_q_b, (n % 2)::int as xovr_cal_q from nodes where n > 9)"


def _seen(spark, sf_dir):
    n = node_rows(spark, sf_dir).where("n > 9")
    return n.select(_id(c("reach")).alias("reach_id"), c("node").alias("node_id"), (c("node") * 200.0 + c("n")).alias("x"), c("wse").alias("y"), c("n").alias("n_good_pix"), "wse", (c("n") % 4).cast("int").alias("node_q"), (c("n") * 1024).alias("node_q_b"), (c("n") % 2).cast("int").alias("xovr_cal_q"))


@query(f"""with $NODES, {_REACHES}, {_SEEN} select p.reach_id, p.node_id, coalesce(n_good_pix, -999999999) as n_good_pix, round(coalesce(wse, -999999999999), 4) as wse, coalesce(node_q, 3) as node_q, coalesce(node_q_b, {completion.NODE_UNSEEN})::bigint as node_q_b, coalesce(xovr_cal_q, 2) as xovr_cal_q,
round(case when q.x is null then -999999999999 else sqrt(pow(q.x - p.x, 2) + pow(q.y - p.y, 2)) end, 3) as node_dist from placed p left join obs q on p.reach_id = q.reach_id and p.node_id = q.node_id where p.reach_id % 10 <> 6""")
def complete_nodes(spark, sf_dir):
    """Every prior node: what was observed, or fills and the bits of one that wasn't."""
    prior = _prior(spark, sf_dir).withColumnsRenamed({"x": "x_prior", "y": "y_prior"}).drop("s")
    out = completion.complete_nodes(prior, _seen(spark, sf_dir))
    return out.select("reach_id", "node_id", "n_good_pix", r("wse", 4).alias("wse"), "node_q", "node_q_b", "xovr_cal_q", r("node_dist", 3).alias("node_dist"))


@query(f"""with $NODES, {_REACHES}, {_SEEN}, g as (select reach_id, count(*) / 50.0 as frac, avg(wse) as wse, max(node_q) as q from obs group by 1 having count(*) > 25)
select r.reach_id, round(coalesce(wse, -999999999999), 4) as wse, coalesce(q, 3) as reach_q, case when q is null then {completion.REACH_UNSEEN} else q * 1024 end::bigint as reach_q_b, case when q is null then {completion.DISCHARGE_UNSEEN} else 0 end::bigint as dschg_q_b, len(list_filter(up, lambda i: i > 0)) as n_up, len(list_filter(down, lambda i: i > 0)) as n_down,
list_transform(down, lambda i: case when i = 0 then -999999999 else i end) as down, case when coalesce(frac, -1) < 0.5 then 1 else 0 end as partial_f from reaches r left join g using (reach_id) where r.reach_id % 10 <> 6""")
def complete_reaches(spark, sf_dir):
    """Every prior reach, with its neighbours."""
    g = _seen(spark, sf_dir).groupBy("reach_id").agg((F.count("*") / 50).alias("obs_frac_n"), F.avg("wse").alias("wse"), F.max("node_q").alias("reach_q"), F.count("*").alias("_n")).where("_n > 25").drop("_n")
    g = g.withColumns({"reach_q_b": c("reach_q").cast("long") * 1024, "dschg_q_b": F.lit(0).cast("long")})
    out = completion.complete_reaches(_reaches(spark, sf_dir).drop("k"), g, _prior(spark, sf_dir))
    return out.select("reach_id", r("wse", 4).alias("wse"), "reach_q", "reach_q_b", "dschg_q_b", c("n_up").cast("long").alias("n_up"), c("n_down").cast("long").alias("n_down"), "down", "partial_f")


@query("""with $PIX, m as (select reach, side = 'F' as constrained, klass, round(avg(h), 5) as q from pix where klass in (1, 2, 3) group by 1, 2, 3)
select reach, max(q) filter (where not constrained and klass = 1) as dschg_m, max(q) filter (where not constrained and klass = 2) as dschg_b, max(q) filter (where not constrained and klass = 3) as dschg_h,
max(q) filter (where constrained and klass = 1) as dschg_gm, max(q) filter (where constrained and klass = 2) as dschg_gb, max(q) filter (where constrained and klass = 3) as dschg_gh from m group by 1""")
def discharge_names(spark, sf_dir):
    """Models with and without gauges as the product's columns."""
    p = pixels(spark, sf_dir).where(c("klass").isin(1, 2, 3)).groupBy("reach", (c("side") == "F").alias("constrained"), F.element_at(F.array(*map(F.lit, "mbh")), c("klass")).alias("model")).agg(r(F.avg("h")).alias("q"))
    return completion.named_discharge(p, "reach", ["m", "b", "h"])


@query("""with $PIX, k as (select unnest(['h', 'h', 'tax', 'pixel', 'sigma']) as field, unnest(['low', 'high', 'high', 'bits', 'low']) as problem, unnest([count(*) filter (where h < 5 and h <> 1), count(*) filter (where h > 100), count(*) filter (where tax > 0.07), count(*) filter (where pixel & ~65535 <> 0), count(*) filter (where sigma < 1.05)]) as n from pix) select field, problem, n from k where n > 0""")
def field_checks(spark, sf_dir):
    """Rules of fields that rows break, all counted in one pass."""
    fields = {"h": {"valid_min": 5.0, "valid_max": 100.0, "fill": 1.0}, "tax": {"valid_max": 0.07}, "pixel": {"flag_masks": [65535]}, "sigma": {"valid_min": 1.05}, "area": {}}
    return completion.check_fields(pixels(spark, sf_dir), fields)


@query("""with $PIX, k as (select unnest(['area', 'frac', 'tax', 'klass', 'node', 'sigma']) as name, unnest([corr(h, area), corr(h, frac), corr(h, tax), corr(h, klass), corr(h, node), corr(h, sigma)]) as value from pix),
t as (select name, value, 'top' as place from k order by value desc, name limit 3), b as (select name, value, 'bottom' as place from k order by value, name limit 3) select name, round(value, 6) as value, place from t union all select name, round(value, 6), place from b""")
def correlates(spark, sf_dir):
    """The columns most and least correlated with height."""
    return completion.correlates(pixels(spark, sf_dir), "h", ["area", "frac", "tax", "klass", "node", "sigma"], 3).withColumn("value", r("value", 6))


_METRICS = """s as (select reach, node, avg(h) filter (where side = 'O') - avg(h) filter (where side = 'F') as wse, (sum(area) filter (where side = 'O') - sum(area) filter (where side = 'F')) / nullif(sum(area) filter (where side = 'F'), 0) * 100 as area, avg(tax) filter (where side = 'O') - avg(tax) filter (where side = 'F') as slope from pix group by 1, 2),
l as (select unnest(['wse_cm', 'area_pct', 'slope_cmkm']) as metric, unnest([wse * 100, area, slope * 100000]) as e from s)"""


@query(f"with $PIX, {_METRICS} select metric, round(quantile_cont(abs(e), 0.68), 4) as p68, round(median(e), 4) as p50, round(avg(e), 4) as mean, count(e) as n from l where e is not null group by 1")
def error_summaries(spark, sf_dir):
    """68 % and 50 % of the errors of all metrics, their mean and number."""
    of = lambda s, v: F.when(c("side") == s, v)
    diff = lambda f, v: f(of("O", v)) - f(of("F", v))
    truth = F.nullif(F.sum(of("F", c("area"))), F.lit(0.0))
    s = pixels(spark, sf_dir).groupBy("reach", "node").agg((diff(F.avg, c("h")) * 100).alias("wse_cm"), (diff(F.sum, c("area")) / truth * 100).alias("area_pct"), (diff(F.avg, c("tax")) * 100000).alias("slope_cmkm"))
    names = ["wse_cm", "area_pct", "slope_cmkm"]
    e = written(s.select(F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), c(n).alias("e")) for n in names))).alias("x")).select("x.*").where("e is not null"), "metric-errors")
    size = quantiles.percentiles(e.withColumn("e", F.abs("e")), ["metric"], "e", {"p68": 0.68}).select("metric", r("p68", 4).alias("p68"))
    mid = quantiles.percentiles(e, ["metric"], "e", {"p50": 0.5}).select("metric", r("p50", 4).alias("p50"))
    return e.groupBy("metric").agg(r(F.avg("e"), 4).alias("mean"), F.count("e").alias("n")).join(size, "metric").join(mid, "metric")
