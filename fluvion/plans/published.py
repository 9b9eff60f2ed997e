"""Whole published rules on driver tables: areas with all terms, discharge flags and uncertainties, sections, outlier filters, science bounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import aggregates as A
from ..operators import assign, metrics, network
from ..operators import discharge as Q
from .catalogue import c, node_rows, pixels, query, r, table
from .network import _CONTINUED, _OBSERVED, _REACHES, _observed, _prior, _reaches

_TERMS = """t as (select reach, node, good, area as pa, frac / 10 as wf, sigma / 20 as ws, 1e-4::double as hs, tax as fr, frac / 20 as mr, case when klass in (2, 3, 1) then 1.0 else 0 end as e, case when klass in (1, 2, 3, 4, 6, 7) then 1.0 else 0 end as u from pix),
p as (select *, 0.5::double as pf, 0.1::double * 0.5 - 0.1::double * 0.5 as bf, 0.1::double * 0.5 + 0.1::double * 0.5 as vf, (1 - mr) * 0.5 + fr * 0.5 as pd, fr * 0.5 + mr * 0.5 as vd from t)"""


@query(f"""with $PIX, {_TERMS},
q as (select *, pf * vd + 0.5 * vf - 2 * mr * 0.5 * 0.1 * 0.5 as vb, (fr * 0.5 - mr * 0.5) * 0.5 + 0.5 * bf as bd, pow(hs * 10 * pa, 2) as dem from p),
s as (select reach, node, sum(pa * pa / 12 * e * 0.5) filter (where good) as size, sum(dem * pd * pf * u) filter (where good) as dd, sum(dem * (ws * ws + wf * wf) * pf * u) filter (where good) as df,
sum(pa * pa * vb * u) filter (where good) as rd, sum(pa * pa * (ws * ws * pf + wf * wf * vf) * u) filter (where good) as rf, sum(pa * bd * u) filter (where good) as b1, sum(pow(pa * bd, 2) * u) filter (where good) as b2,
sum(pa * wf * bf * u) filter (where good) as f1, sum(pow(pa * wf * bf, 2) * u) filter (where good) as f2, coalesce(sum(e) / nullif(sum(u), 0), 0) as k from q group by 1, 2),
m as (select q.reach, q.node, pow(sum((1 - k) * pa * bd + k * pa * wf * bf), 2) - sum(pow((1 - k) * pa * bd + k * pa * wf * bf, 2)) as mixed from q join s using (reach, node) group by 1, 2)
select reach, node, round(sqrt(size + dd + rd + pow(b1, 2) - b2), 4) as detected, round(sqrt(size + df + rf + pow(f1, 2) - f2), 4) as fraction,
round(sqrt(0.1 * size + rf * k + (1 - k) * rd + df * k + (1 - k) * dd + mixed), 4) as composite, round(sqrt(0.1 * size + rf * k + (1 - k) * rd + df * k + (1 - k) * dd + mixed) / 200, 6) as width_u from s join m using (reach, node)""")
def area_uncertainty_terms(spark, sf_dir):
    """All terms of the deviations of a node's area, three ways, and the width's."""
    p = pixels(spark, sf_dir)
    u = A.area_uncertainty(c("area"), c("frac") / 10, c("sigma") / 20, F.lit(1e-4), c("tax"), c("frac") / 20, c("klass"), c("good"), interior=(4, 6, 7), edges=(1, 2, 3))
    out = p.groupBy("reach", "node").agg(*(v.alias(k) for k, v in u.items()))
    return out.select("reach", "node", *(r(k, 4).alias(k) for k in u), r(c("composite") / 200, 6).alias("width_u"))


_FLOWS = """hy as (select reach, sum(area) / 100.0 as w, avg(wse) as h, (count(*) - 45) / 100000.0 as s, sum(area) - 15500 as da, reach % 4 as quality from nodes group by 1)"""


def _flows(spark, sf_dir):
    g = node_rows(spark, sf_dir).groupBy("reach")
    return g.agg((F.sum("area") / 100).alias("w"), F.avg("wse").alias("h"), ((F.count("*") - 45) / 100000).alias("s"), (F.sum("area") - 15500).alias("da")).withColumn("quality", c("reach") % 4)


_BASES = {"metroman": 200.0, "bam": 400.0, "hivdi": 800.0, "sads": 1600.0, "sic4dvar": 3200.0}


def _six(base):
    w, s, da, n = c("w"), c("s"), c("da"), F.lit(0.03)
    return {
        "metroman": Q.metroman(w, s, da, base["metroman"], n, F.lit(-0.1)), "bam": Q.constant_n(w, s, da, base["bam"], n), "hivdi": Q.hivdi(w, s, da, base["hivdi"], F.lit(30.0), F.lit(0.05)),
        "momma": Q.momma(w, s, c("h"), F.lit(35.5), 30 + c("reach") % 10, F.lit(1e-4)), "sads": Q.constant_n(w, s, da, base["sads"], n), "sic4dvar": Q.constant_n(w, s, da, base["sic4dvar"], n),
    }


@query(f"""with $NODES, {_FLOWS}, k as (select *, (w > 0 and s > 0)::int as ok from hy),
m as (select *, (case when ok = 1 then {' + '.join(f'(da + {v} >= 0)::int' for v in _BASES.values())} + (h > 35.5 and 30 + reach % 10 > 35.5 and 1 + case when h <= 30 + reach % 10 then 1 else -1 end * log10(greatest((30 + reach % 10 - 35.5) / (h - 35.5), 1e-300)) > 0)::int else 0 end) as n from k)
select reach, ((quality = 1)::bigint + 2 * coalesce(2e-5 / nullif(s, 0) > 0.4, false)::bigint + 8 * (da + 200 < 0)::bigint + 16 * (da + 400 < 0)::bigint + 32 * (da + 800 < 0)::bigint + 64 * (35.5 > 30 + reach % 10)::bigint + 128 * (da + 1600 < 0)::bigint + 256 * (da + 3200 < 0)::bigint
+ 2048 * (n > 0 and n < 6)::bigint + 262144 * (quality = 2)::bigint + 4194304 * (quality = 3)::bigint + 8388608 * (n = 0)::bigint + 16777216 * (s < 0)::bigint)::bigint as flag from m""")
def discharge_flag(spark, sf_dir):
    """All bits of the discharge flag."""
    base = {k: F.lit(v) for k, v in _BASES.items()}
    f = _flows(spark, sf_dir)
    return f.select("reach", Q.flag(c("quality"), c("s"), F.lit(2e-5), c("da"), base, F.lit(35.5), 30 + c("reach") % 10, _six(base)).alias("flag"))


_RANDOM = "sqrt(pow(({p} - 2 / 3.0::double) / w * w / 20, 2) + pow((5 / 3.0::double - {p}) / ({b} + da) * 50, 2) + pow(1e-6 / (2 * s), 2))"


@query(f"""with $NODES, hy as (select reach, sum(area) / 100.0 as w, count(*) / 100000.0 as s, sum(area) - 10000 as da, avg(wse) as h from nodes group by 1),
q as (select *, {_RANDOM.format(p='-0.1', b='9000.0')} as r1, {_RANDOM.format(p='0.0', b='9500.0')} as r2, {_RANDOM.format(p='0.0', b='12000.0')} as r3, pow(da + 9000, 5 / 3.0::double) * pow(w, -2 / 3.0::double) * sqrt(s) / (0.03 * pow((da + 9000) / w, -0.1)) as q1, pow(da + 9500, 5 / 3.0::double) * pow(w, -2 / 3.0::double) * sqrt(s) / 0.03 as q2, pow(da + 12000, 5 / 3.0::double) * pow(w, -2 / 3.0::double) * sqrt(s) / 0.04 as q3 from hy),
z as (select *, 0.2 * r1 / sqrt(1 - 0.04::double) as s1, 0.3 * r2 / sqrt(1 - 0.09::double) as s2, 0.4 * r3 / sqrt(1 - 0.16::double) as s3 from q), a as (select *, sqrt(pi() / 2 * pow((s1 + s2 + s3) / 3, 2) / 3) as ss from z)
select reach, round(list_sort([q1, q2, q3])[2], 3) as q, round(ss, 6) as q_s_u, round(sqrt(ss * ss + pow(list_sort([r1, r2, r3])[2], 2)), 6) as q_u, round(ss / sqrt(ss * ss + pow(list_sort([r1, r2, r3])[2], 2)), 6) as q_s_rel, round(case when h >= 30 then 0.05 * pow((da + 30) / w, 1.2) * pow(h - 30, 1.2) end, 5) as q_low from a where da + 30 >= 0""")
def consensus_uncertainty(spark, sf_dir):
    """Random, systematic and total uncertainty of a consensus of three models, and the form for low slopes."""
    f = node_rows(spark, sf_dir).groupBy("reach").agg((F.sum("area") / 100).alias("w"), (F.count("*") / 100000).alias("s"), (F.sum("area") - 10000).alias("da"), F.avg("wse").alias("h")).where("da + 30 >= 0")
    w, s, da = c("w"), c("s"), c("da")
    random = [Q.metroman_random(w, w / 20, s, F.lit(1e-6), da, F.lit(50.0), F.lit(b), F.lit(p)) for b, p in ((9000.0, -0.1), (9500.0, 0.0), (12000.0, 0.0))]
    models = [Q.metroman(w, s, da, F.lit(9000.0), F.lit(0.03), F.lit(-0.1)), Q.constant_n(w, s, da, F.lit(9500.0), F.lit(0.03)), Q.constant_n(w, s, da, F.lit(12000.0), F.lit(0.04))]
    parts = Q.consensus_parts(models, [Q.split_uncertainty(x, F.lit(k))[0] for x, k in zip(random, (0.2, 0.3, 0.4), strict=True)], random)
    low = Q.low_slope(w, c("h"), da, F.lit(30.0), F.lit(0.05), F.lit(1.2))
    return f.select("reach", r(parts["q"], 3).alias("q"), *(r(parts[k], 6).alias(k) for k in ("q_s_u", "q_u", "q_s_rel")), r(low).alias("q_low"))


_LINES = [(2.0, 10.0), (4.0, -58.0), (0.0, 86.0)]


def _piece(h: str) -> str:
    return f"case when {h} >= 32 and {h} < 34 then 0 when {h} >= 34 and {h} < 36 then 1 when {h} >= 36 and {h} < 38 then 2 end"


def _slope(k: str) -> str:
    return f"case {k} when 0 then 2.0 when 1 then 4.0 when 2 then 0.0 end::double"


def _icept(k: str) -> str:
    return f"case {k} when 0 then 10.0 when 1 then -58.0 when 2 then 86.0 end::double"


@query(f"""with $NODES, g as (select reach, node, wse as h, area / 3 as w, 0.2 + node % 2 * 3 as spread from nodes), a as (select *, (spread - 0.25) / 0.25 < 2 as noisy, {_piece('h')} as k from g),
b as (select *, {_slope('k')} as m, {_icept('k')} as i from a), d as (select *, case when noisy then h else h + (w - i - m * h) * m * 0.25 / (9 + m * m * 0.25) end as h1 from b), e as (select *, {_piece('h1')} as k1, coalesce({_piece('h1')}, k) as kk from d),
f as (select *, {_slope('kk')} as s2, {_icept('kk')} as i2 from e), x as (select *, case when k1 is not null then h + (w - i2 - s2 * h) * s2 * 0.25 / (9 + s2 * s2 * 0.25) else h1 end as hat from f),
y as (select *, least(hat, 34) * least(hat, 34) + 10 * least(hat, 34) - 32 * 32 - 320 + case when kk >= 1 then 2 * pow(least(hat, 36), 2) - 58 * least(hat, 36) - (2 * 34 * 34 - 58 * 34) else 0 end + case when kk >= 2 then 86 * (least(hat, 38) - 36) else 0 end - 150 as inside, 34.0 + 2 * kk as top from x)
select reach, node, round(case when k is not null then inside when h >= 38 then 86 * 2 + 150 else -150 - (32 - h) * (w + 74) / 2 end, 4) as d_area,
round(case when k is null then sqrt(0.25 * w * w + 18 * pow(h - case when h >= 38 then 38 else 32 end, 2)) when s2 = 0 then i2 * 0.5 else sqrt(4 * pow(sqrt(s2 / 2) * (hat - top) + (s2 * top + i2) / sqrt(2 * nullif(s2, 0)), 2) * (s2 / 2 * 0.25) + 2 * pow(s2 / 2 * 0.25, 2)) end, 4) as d_area_u,
round(case when k is not null and not noisy then s2 * hat + i2 else w end, 4) as width, round(case when k is not null then hat end, 5) as height from y""")
def section_change(spark, sf_dir):
    """Sections by pieces, corrected for errors in height and width, below and beyond the breaks as well."""
    g = node_rows(spark, sf_dir).select("reach", "node", c("wse").alias("h"), (c("area") / 3).alias("w"), (0.2 + c("node") % 2 * 3).alias("spread"))
    lines = [(F.lit(a), F.lit(b)) for a, b in _LINES]
    x = Q.section_change(g, c("h"), F.lit(0.5), c("w"), F.lit(3.0), [F.lit(float(k)) for k in (32, 34, 36, 38)], lines, F.lit(150.0), F.lit(9.0), F.lit(0.25), c("spread"))
    return x.select("reach", "node", r("d_area", 4).alias("d_area"), r("d_area_u", 4).alias("d_area_u"), r("fit_width", 4).alias("width"), r("fit_height").alias("height"))


@query("""with $NODES, x as (select reach as reach_id, node as node_id, node * 200.0::double as s, wse, n::double as w, wse > 20 and wse < 60 as valid from nodes),
m as (select reach_id, sum(w * s) / sum(w) as ms, sum(w * wse) / sum(w) as my, count(*) as k from x where valid group by 1), f as (select reach_id, any_value(k) as k, sum(w * (s - ms) * (wse - my)) / nullif(sum(w * (s - ms) * (s - ms)), 0) as b, any_value(my) - sum(w * (s - ms) * (wse - my)) / nullif(sum(w * (s - ms) * (s - ms)), 0) * any_value(ms) as a from x join m using (reach_id) where valid group by 1)
select reach_id, node_id, valid, valid and (k <= 3 or b is null or abs(wse - a - b * s) < greatest(abs(b) * 1000, 5)) as good from x left join f using (reach_id)""")
def coarse_good(spark, sf_dir):
    """Valid heights, and those near the weighted line."""
    n = node_rows(spark, sf_dir).select(c("reach").alias("reach_id"), c("node").alias("node_id"), (c("node") * 200.0).alias("s"), "wse", (1 / F.sqrt("n")).alias("wse_u"))
    return assign.coarse_good(n, low=20.0, high=60.0, per_km=1.0, least=5.0).select("reach_id", "node_id", "valid", "good")


@query(f"""with $NODES, {_REACHES}, {_OBSERVED}, {_CONTINUED}, down as (select s.reach_id, long as down from sides s join ends e on e.reach_id = s.other where side = -1),
parts as (select reach_id, side as part, other from sides union all select reach_id, 0, reach_id from reaches),
st as (select p.reach_id, part, n.node_id, case part when -1 then 0 when 0 then coalesce(down, 0) else coalesce(down, 0) + long end + n.s as ss, node_q, wse from parts p join ends e on e.reach_id = p.reach_id left join down d on d.reach_id = p.reach_id join placed n on n.reach_id = p.other join seen q on q.reach_id = n.reach_id and q.node_id = n.node_id),
g as (select *, wse < 38 and n0 as good from (select *, part = 0 or node_q < 3 as n0 from st)), o as (select *, row_number() over w as k, first_value(case when good then ss end ignore nulls) over (w rows between 1 following and unbounded following) as nxt from g window w as (partition by reach_id order by ss, part, node_id)),
c as (select *, max(case when good and nxt - ss > 600 and part = -1 then k end) over (partition by reach_id) as dn, min(case when good and nxt - ss > 600 and part = 1 then k end) over (partition by reach_id) as up from o)
select reach_id, part, node_id, good and not coalesce(k <= dn, false) and not coalesce(k >= up, false) as good from c""")
def gap_filter(spark, sf_dir):
    """Neighbours' nodes beyond gaps, and bad ones, go."""
    rows = network.stitched(_reaches(spark, sf_dir), _prior(spark, sf_dir), _observed(spark, sf_dir), all_nodes=False).withColumn("good", c("wse") < 38)
    return assign.neighbour_filter(rows, gap=600.0).select("reach_id", "part", "node_id", "good")


_REACHED = """q as (select reach, sum(area) filter (where side = 'F') * 100 as area, sum(area) * 2 / 100 as width, count(distinct node) * 170.0 as length, min(h) * 12000 as xtrk, 1 - 0.2 * (reach % 5 = 0)::int as tof, count(distinct node) filter (where side = 'O') / 52.0 as obs, avg(frac) / 10 as dark, 0.4 + max(tax) * 12 - reach % 3 * 0.01 as ddark, reach % 6 * 8000000 as flag, count(distinct node) filter (where h between 10 and 60) / 60.0 as ratio from pix group by 1)"""


def _scored(spark, sf_dir):
    of = lambda s, v: F.when(c("side") == s, v)
    # by node first: distinct nodes are counted as rows, without a copy of every pixel for each count
    n = pixels(spark, sf_dir).groupBy("reach", "node").agg(
        F.sum(of("F", c("area"))).alias("area_F"), F.sum("area").alias("area"), F.min("h").alias("h"), F.count_if(c("side") == "O").alias("seen"), F.sum("frac").alias("frac"), F.count("frac").alias("fracs"), F.max("tax").alias("tax"), F.count_if(c("h").between(10, 60)).alias("near"),
    )
    nodes = lambda ok: F.count_if(ok & c("node").isNotNull())
    g = n.groupBy("reach").agg(
        (F.sum("area_F") * 100).alias("area"), (F.sum("area") * 2 / 100).alias("width"), (F.count("node") * 170.0).alias("length"), (F.min("h") * 12000).alias("xtrk"),
        (nodes(c("seen") > 0) / 52.0).alias("obs_frac"), (F.sum("frac") / F.nullif(F.sum("fracs"), F.lit(0)) / 10).alias("dark_frac"), (0.4 + F.max("tax") * 12).alias("data_dark_frac"), (nodes(c("near") > 0) / 60.0).alias("xtrk_ratio"),
    )
    k = c("reach")
    return g.withColumns({"truth_obs_frac": 1 - 0.2 * (k % 5 == 0).cast("int"), "flag": k % 6 * 8000000, "data_dark_frac": c("data_dark_frac") - k % 3 * 0.01})


@query(f"""with $PIX, {_REACHED} select reach, coalesce(abs(xtrk) > 10000 and abs(xtrk) < 60000 and width > 100 and area > 800000 and length >= 8000 and tof >= 1 and dark <= 1 and flag <= 33554432 and ratio >= 0.5 and obs >= 0.5, false) as in_science from q""")
def science_bounds(spark, sf_dir):
    """Reaches within all bounds of the science requirements."""
    return metrics.science(_scored(spark, sf_dir)).select("reach", "in_science")


@query(f"""with $PIX, {_REACHED} select count(*) as n, count(*) filter (where abs(xtrk) < 10000 or abs(xtrk) > 60000) as bad_xtrk, count(*) filter (where width < 100) as bad_width, count(*) filter (where area < 800000) as bad_area, count(*) filter (where length < 8000) as bad_length,
count(*) filter (where obs < 0.5) as bad_obs_frac, count(*) filter (where ddark >= 1) as bad_dark_frac, count(*) filter (where flag > 33554432) as bad_flag, count(*) filter (where ratio < 0.5) as bad_xtrk_ratio from q""")
def science_bound_counts(spark, sf_dir):
    """How many reaches each bound leaves out."""
    return metrics.outside_counts(_scored(spark, sf_dir))


@query(f"""with $PIX, k as (select pixel, klass, case when klass < 3 then area end as stored, case when klass < 5 then radians(1 + frac / 10) end as look, case when klass < 7 then 22.0 end as ground, h, frac, tax, sigma from pix)
select pixel, klass, round(coalesce(stored, 21.0 * 0.75 / sin(look * (1 + {geo.ORBIT!r} / {geo.STEP_RADIUS!r})), 21.0 * ground, 0), 4) as area,
round(frac * cos(-2 * pi() / 0.0084 * (h - sigma)) - tax * sin(-2 * pi() / 0.0084 * (h - sigma)), 5) + 0.0 as re, round(frac * sin(-2 * pi() / 0.0084 * (h - sigma)) + tax * cos(-2 * pi() / 0.0084 * (h - sigma)), 5) + 0.0 as im,
round(2 * {geo.STEP_RADIUS!r} * asin(sqrt(least(pow(sin(radians(tax) / 2), 2) + cos(radians(40.0)) * cos(radians(40.0 + tax)) * pow(sin(radians(h / 50) / 2), 2), 1.0))), 2) as metres, greatest(least(round_even((h - 10) / 0.7, 0)::bigint, 99), 0) as cell,
format('{{:d}} {{:d}} {{:.2f}}{{}}', floor(abs(h - 50))::int, floor((abs(h - 50) - floor(abs(h - 50))) * 60)::int, ((abs(h - 50) - floor(abs(h - 50))) * 60 - floor((abs(h - 50) - floor(abs(h - 50))) * 60)) * 60, case when h - 50 < 0 then 'S' else 'N' end) as place from k""")
def pixel_geometry(spark, sf_dir):
    """Pixel areas by what is known, flattened phases, distances on the sphere, cells of a raster's axis and angles as text."""
    k, h = c("klass"), c("h")
    stored, look, ground = F.when(k < 3, c("area")), F.when(k < 5, F.radians(1 + c("frac") / 10)), F.when(k < 7, F.lit(22.0))
    area = geo.pixel_area(stored, F.lit(21.0), F.lit(0.75), look, ground)
    re, im = geo.flattened(c("frac"), c("tax"), 0.0084, h, c("sigma"))
    metres, _ = geo.great_circle(F.lit(0.0), F.lit(40.0), h / 50, 40 + c("tax"))
    return pixels(spark, sf_dir).select(
        "pixel", "klass", r(F.coalesce(area, F.lit(0.0)), 4).alias("area"), (r(re) + 0.0).alias("re"), (r(im) + 0.0).alias("im"), r(metres, 2).alias("metres"), geo.raster_index(h, 10.0, 0.7, 100).alias("cell"), geo.degrees_text(h - 50, "N", "S").alias("place")
    )


@query("""select e.c_custkey, c_nationkey, coalesce(n, 0) as n from customer e left join (select o_custkey, count(*) as n from orders where o_totalprice > 100000 group by 1) o on o_custkey = c_custkey""")
def attributes_on_rows(spark, sf_dir):
    """Attributes of one table copied onto the rows of another, with a default."""
    found = table(spark, sf_dir, "orders").where("o_totalprice > 100000").groupBy(c("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(found, "c_custkey", "left").fillna({"n": 0})
