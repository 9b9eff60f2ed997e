"""Queries on nodes and reaches: groups, quality flags, widths, areas and what is carried from pixels to nodes to reaches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, quality
from ..operators import aggregates as A
from ..operators import fits
from .catalogue import c, query, r, table

#: lineitem as pixels with everything that the flags need.
RICH = """px as (select l_orderkey as pixel, l_linenumber as klass, l_suppkey as reach, l_partkey % 50 as node, l_extendedprice / 997 as h, l_extendedprice / 997 - 50 as n,
l_quantity as area, l_discount * 40 as frac, l_tax as tax, (l_partkey - 1000) * 65.0 as xtrack, l_linenumber < 6 as wse_class, l_orderkey % 7 = 0 as degraded, l_orderkey % 5 = 0 as suspect,
l_orderkey % 3 > 0 as sig0, l_orderkey % 211 = 0 as bright from lineitem)"""


def rich(spark, sf_dir):
    k = c("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        k.alias("pixel"), c("l_linenumber").alias("klass"), c("l_suppkey").alias("reach"), (c("l_partkey") % 50).alias("node"), (c("l_extendedprice") / 997).alias("h"), (c("l_extendedprice") / 997 - 50).alias("n"),
        c("l_quantity").alias("area"), (c("l_discount") * 40).alias("frac"), c("l_tax").alias("tax"), ((c("l_partkey") - 1000) * 65.0).alias("xtrack"), (c("l_linenumber") < 6).alias("wse_class"),
        (k % 7 == 0).alias("degraded"), (k % 5 == 0).alias("suspect"), (k % 3 > 0).alias("sig0"), (k % 211 == 0).alias("bright"),
    )


FLAGGED = RICH + """, g as (select reach, node, count(*) as n_pix, count(*) filter (where sig0) as n_sig0, count(*) filter (where not degraded) as area_good, count(*) filter (where wse_class and not degraded) as wse_good,
 count(*) filter (where wse_class) as n_class, count(*) filter (where sig0 and suspect) as s_sig0, count(*) filter (where suspect and not degraded) as s_area, count(*) filter (where suspect and wse_class and not degraded) as s_wse,
 count(*) filter (where degraded) as d_area, count(*) filter (where degraded and wse_class) as d_wse, count(*) filter (where bright) as bright, max(frac) filter (where not degraded) as frac_good, max(frac) as frac_all,
 min(n) as low, max(n) as high, median(xtrack) as xtrack, avg(h) * 200 as wse, sum(area) as area from px group by 1, 2),
u as (select *, case when wse_good >= 3 then wse_good else n_class end as n_wse, case when area_good >= 3 then area_good else n_pix end as n_area, case when area_good >= 3 then frac_good else frac_all end as f, (node - 20) * 1.8 as width from g),
fl as (select reach, node, wse, xtrack, area, n_wse, s_wse, d_wse, n_pix, (case when s_sig0 > 0 then 1 else 0 end + case when s_area > 0 then 2 else 0 end + case when s_wse > 0 then 4 else 0 end + case when f > 3 then 8 else 0 end
 + case when (width < 0 and low < 0.9 * width) or (width > 0 and high > 0.9 * width) then 16 else 0 end + case when bright > 0 then 128 else 0 end + case when n_sig0 < 10 then 512 else 0 end
 + case when n_area < 10 then 1024 else 0 end + case when n_wse < 10 then 2048 else 0 end + case when abs(xtrack) > 60000 then 8192 else 0 end + case when abs(xtrack) < 10000 then 16384 else 0 end
 + case when area_good < 3 and d_area > 0 then 262144 else 0 end + case when wse_good < 3 and d_wse > 0 then 524288 else 0 end + case when wse < -500 or wse > 8000 then 16777216 else 0 end
 + case when n_sig0 = 0 then 33554432 else 0 end + case when n_area = 0 then 67108864 else 0 end + case when n_wse = 0 then 134217728 else 0 end)::bigint as flag from u)"""


def flagged(spark, sf_dir):
    """Nodes with their flag."""
    good, used, x = ~c("degraded"), c("wse_class"), rich(spark, sf_dir)
    g = x.groupBy("reach", "node").agg(
        F.count("*").alias("pixels"), F.count_if("sig0").alias("sig0"), F.count_if(good).alias("area_good"), F.count_if(used & good).alias("wse_good"), F.count_if(used).alias("wse_class"),
        F.count_if(c("sig0") & c("suspect")).alias("sig0_suspect"), F.count_if(c("suspect") & good).alias("area_suspect"), F.count_if(c("suspect") & used & good).alias("wse_suspect"),
        F.count_if("degraded").alias("area_degraded"), F.count_if(c("degraded") & used).alias("wse_degraded"), F.count_if("bright").alias("bright"), F.max(A.only(c("frac"), good)).alias("frac_good"), F.max("frac").alias("frac_all"),
        F.min("n").alias("low"), F.max("n").alias("high"), F.median("xtrack").alias("xtrack"), (F.avg("h") * 200).alias("wse"), F.sum("area").alias("node_area"),
    )
    g = g.withColumn("enough_area", c("area_good") >= 3).withColumn("enough_wse", c("wse_good") >= 3)
    g = g.withColumn("area", F.when(c("enough_area"), c("area_good")).otherwise(c("pixels"))).withColumn("n_wse", F.when(c("enough_wse"), c("wse_good")).otherwise(c("wse_class")))
    counts = {n: c(n) for n in ("pixels", "sig0", "area", "sig0_suspect", "area_suspect", "wse_suspect", "area_degraded", "wse_degraded", "bright", "enough_area", "enough_wse")} | {"wse": c("n_wse")}
    width = (c("node") - 20) * 1.8
    fraction = F.when(c("enough_area"), c("frac_good")).otherwise(c("frac_all"))
    return g.withColumn("flag", quality.node_flag(counts, c("wse"), c("xtrack"), fraction, quality.blocked(c("low"), c("high"), width)))


@query(f"with {FLAGGED} select reach, node, flag, case when flag = 0 then 0 when flag < 262144 then 1 when flag < 4194304 then 2 else 3 end as q from fl")
def node_quality(spark, sf_dir):
    return flagged(spark, sf_dir).select("reach", "node", "flag", quality.summary(c("flag")).alias("q"))


@query(f"""with {FLAGGED}, o as (select reach, bit_or(flag) filter (where node % 9 > 0) as any_flag, bit_and(flag) filter (where node % 9 > 0) as all_flag, count(*) / 50.0 as seen, count(*) filter (where node % 9 > 0) as k,
avg((flag & 1024 > 0)::int) filter (where wse between -500 and 8000) as few_area, avg((flag & 2048 > 0)::int) filter (where wse between -500 and 8000) as few_wse from fl where n_pix > 2 group by 1),
w as (select reach, (coalesce(any_flag, 0) & ~(1 + 16 + 512 + 1024 + 2048 + 8388608 + 16777216 + 33554432 + 67108864 + 134217728 + 268435456)::bigint) | (case when few_area >= 0.5 then 1024 else 0 end)
 | (case when few_wse >= 0.5 then 2048 else 0 end) | (case when seen < 0.9 then 32768 else 0 end) | (case when k < 30 then 33554432 else 0 end) | (coalesce(all_flag, 0) & (67108864 + 134217728 + 268435456)::bigint) as flag from o)
select reach, flag::bigint as flag, case when flag = 0 then 0 when flag < 262144 then 1 when flag < 4194304 then 2 else 3 end as q from w""")
def reach_quality(spark, sf_dir):
    n = flagged(spark, sf_dir).where("pixels > 2")
    g = n.groupBy("reach").agg(quality.reach_flag(c("flag"), c("node") % 9 > 0, c("wse").between(quality.LOWEST, quality.HIGHEST), F.count("*") / 50, 30, least_observed=0.9).alias("flag"))
    return g.select("reach", "flag", quality.summary(c("flag")).alias("q"))


@query(f"""with {RICH}, g as (select reach, node, count(*) filter (where suspect and wse_class and not degraded) as s1, count(*) filter (where suspect and wse_class) as s0, count(*) filter (where bright and wse_class and not degraded) as d1,
count(*) filter (where bright and wse_class) as d0, count(*) filter (where wse_class and not degraded) as n1, count(*) filter (where wse_class) as n0 from px group by 1, 2)
select reach, node, case when (case when n1 >= 3 then d1 else d0 end) > 0 or (case when n1 >= 3 then n1 else n0 end) = 0 then 2 when (case when n1 >= 3 then s1 else s0 end) > 0 then 1 else 0 end as q from g""")
def crossover_quality(spark, sf_dir):
    used, good = c("wse_class"), c("wse_class") & ~c("degraded")
    g = rich(spark, sf_dir).groupBy("reach", "node").agg(
        *(F.count_if(c(n) & good).alias(f"{n}_1") for n in ("suspect", "bright")), *(F.count_if(c(n) & used).alias(f"{n}_0") for n in ("suspect", "bright")), F.count_if(good).alias("n_1"), F.count_if(used).alias("n_0")
    )
    of = lambda n: F.when(c("n_1") >= 3, c(f"{n}_1")).otherwise(c(f"{n}_0"))
    return g.select("reach", "node", quality.crossover(of("suspect"), of("bright"), of("n")).alias("q"))


@query(f"""with {RICH}, g as (select reach, node, count(*) as n from px where klass < 3 group by 1, 2 having count(*) >= 2), prior as (select s_suppkey as reach, unnest(range(0, 50)) as node from supplier)
select reach, node, coalesce(n, 0) as n, n is not null as populated from prior left join g using (reach, node)""")
def populated_nodes(spark, sf_dir):
    prior = table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("reach"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(49).cast("long"))).alias("node"))
    return A.populated(rich(spark, sf_dir).where("klass < 3"), prior, ["reach", "node"], 2)


@query(f"""with {RICH} select reach, node, round(max(n) - min(n), 5) as extent, round(sqrt(12) * stddev_pop(n), 5) as spread, round(coalesce(sum(area), 0) / 200.0, 5) as by_area from px group by 1, 2""")
def node_widths(spark, sf_dir):
    w = A.widths(c("n"), c("area"), F.lit(200.0))
    return rich(spark, sf_dir).groupBy("reach", "node").agg(*(r(v).alias(k) for k, v in w.items()))


@query(f"""with {RICH}, g as (select reach, node, avg(tax) as dry, avg(frac) as wet, avg(h) as iono, count(*) filter (where wse_class and not degraded) as n_good from px group by 1, 2)
select reach, round(avg(dry) filter (where n_good > 1), 6) as dry, round(avg(wet) filter (where n_good > 1), 5) as wet, round(avg(iono) filter (where n_good > 1), 5) as iono from g group by 1""")
def ancillary_means(spark, sf_dir):
    x = rich(spark, sf_dir).withColumns({"dry": c("tax"), "wet": c("frac"), "iono": c("h"), "used": c("wse_class") & ~c("degraded")})
    names = ["dry", "wet", "iono"]
    nodes = x.groupBy("reach", "node").agg(*(F.avg(n).alias(n) for n in names), F.count_if("used").alias("n_good"))
    reaches = nodes.groupBy("reach").agg(*(F.avg(A.only(c(n), c("n_good") > 1)).alias(n) for n in names))
    return reaches.select("reach", r("dry", 6).alias("dry"), r("wet").alias("wet"), r("iono").alias("iono"))


@query(f"""with {RICH} select reach, pixel % 4 as scene, round(avg(case when abs(xtrack) > 10000 and abs(xtrack) < 60000 then 1.0 else 0.0 end), 6) as ratio from px group by 1, 2""")
def xtrack_ratio(spark, sf_dir):
    x = rich(spark, sf_dir).withColumn("scene", c("pixel") % 4)
    return x.groupBy("reach", "scene").agg(r(A.in_swath(c("xtrack")), 6).alias("ratio"))


@query(f"""with {RICH}, g as (select reach, node, avg(tax) as geoid, count(*)::double as w from px group by 1, 2), m as (select reach, sum(w * node) / sum(w) as mx, sum(w * geoid) / sum(w) as my from g group by 1)
select reach, round(sum(w * (node - mx) * (geoid - my)) / sum(w * (node - mx) * (node - mx)), 8) as slope, round(any_value(my) - sum(w * (node - mx) * (geoid - my)) / sum(w * (node - mx) * (node - mx)) * any_value(mx), 7) as height
from g join m using (reach) group by 1""")
def geoid_slope(spark, sf_dir):
    nodes = rich(spark, sf_dir).groupBy("reach", "node").agg(F.avg("tax").alias("geoid"), F.count("*").cast("double").alias("w"))
    fit = fits.weighted_line(nodes, ["reach"], "node", "geoid", "w")
    return fit.select("reach", r("slope", 8).alias("slope"), r("intercept", 7).alias("height"))


@query(f"""with {RICH} select pixel, klass, round(case when h - 250 > -200 then h + (h - 250) + tax + frac else h end, 5) as height from px where n > -40 and not bright and frac > 0""")
def uncorrected_tides(spark, sf_dir):
    x = rich(spark, sf_dir).withColumn("frac", F.when(c("frac") > 0, c("frac"))).withColumn("n", F.when(c("n") > -40, c("n")))
    kept = A.usable(x, ["n", "frac"], c("bright"))
    return kept.select("pixel", "klass", r(geo.uncorrected_height(c("h"), c("h") - 250, c("tax"), c("frac"))).alias("height"))


@query(f"""with {RICH}, g as (select reach, node, sum(area) as area, sum(area) filter (where klass < 7) * 1.29871 - sum(area) filter (where klass = 1) as det from px group by 1, 2)
select reach, node, round(case when area > 0 then least(1 - det / area, 1.0) end, 6) as dark, case when node = 7 then -1 else node end as low from g""")
def dark_fraction(spark, sf_dir):
    g = rich(spark, sf_dir).groupBy("reach", "node").agg(F.sum("area").alias("area"), (F.sum(A.only(c("area"), c("klass") < 7)) * 1.29871 - F.sum(A.only(c("area"), c("klass") == 1))).alias("det"))
    return g.select("reach", "node", r(geo.dark_fraction(c("area"), c("det")), 6).alias("dark"), geo.unless_fill(c("node"), 7, F.lit(-1)).alias("low"))


@query(f"""with {FLAGGED}, lake as (select s_suppkey as reach from supplier where s_nationkey % 3 = 1)
select reach, node, case when reach in (select reach from lake) then null else area end as area, case when reach in (select reach from lake) then flag | 4194304 else flag end as flag,
case when reach in (select reach from lake) or flag >= 4194304 then 3 when flag >= 262144 then 2 when flag > 0 then 1 else 0 end as q from fl""")
def lake_mask(spark, sf_dir):
    lakes = table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("reach"), (c("s_nationkey") % 3 == 1).alias("lake"))
    nodes = flagged(spark, sf_dir).select("reach", "node", c("node_area").alias("area"), "flag", quality.summary(c("flag")).alias("q"))
    return A.without_lakes(nodes, lakes, ["reach"], ["area"], "flag", "q")


@query(f"""with {RICH}, t as (select *, case when klass < 3 then 'F' when klass < 5 then 'E' else 'I' end as part from px), q as (select *, (n + 50) / 100 as dh, tax + 0.05 as w from t),
m as (select reach, node, count(*) as k, sum(w) as sw, avg(frac * w) as re, avg(tax * w) as im, avg((1 + frac) * w) as p1, avg((1 + tax) * w) as p2, avg(klass) as looks, avg(dh * w) as d1, avg(dh * dh * w) as d2 from q group by 1, 2),
v as (select *, sqrt(re * re + im * im) / sqrt(p1 * p2) as g from m)
select reach, node, round(g, 6) as coherence, round(sqrt(greatest(0.5 / (looks * k) * (1 - g * g) / (g * g), 1e-10)) * abs(d2 / d1), 5) as height_u from v where g > 0""")
def multilook_uncertainty(spark, sf_dir):
    x = rich(spark, sf_dir).withColumn("dh", (c("n") + 50) / 100).withColumn("w", c("tax") + 0.05)
    found = A.multilook(c("frac"), c("tax"), 1 + c("frac"), 1 + c("tax"), c("klass"), c("w"), {"height": c("dh")})
    g = x.groupBy("reach", "node").agg(*(v.alias(k) for k, v in found.items())).where("coherence > 0")
    return g.select("reach", "node", r("coherence", 6).alias("coherence"), r("height_u").alias("height_u"))
