"""Queries in two dimensions: overlapping boxes, rasters, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import spatial
from .catalogue import c, query, r, table

_LEFT = """l as (select c_custkey, c_custkey * 7 % 3600 / 10.0 - 180 as x0, c_custkey * 13 % 1500 / 10.0 - 75 as y0, 0.1 + c_custkey % 37 / 10.0 as w, 0.1 + c_custkey % 11 / 5.0 as t from customer)"""
_RIGHT = """b as (select s_suppkey, s_suppkey * 97 % 3600 / 10.0 - 180 - 0.25 as x0, s_suppkey * 31 % 1500 / 10.0 - 75 - 0.25 as y0, 0.5 + s_suppkey % 9 + 0.5 as w, 0.5 + s_suppkey % 5 + 0.5 as t from supplier)"""


@query(f"""with {_LEFT}, {_RIGHT}, d as (select c_custkey, s_suppkey, b.x0 - l.x0 - 360 * floor((b.x0 - l.x0) / 360) as east, l.x0 - b.x0 - 360 * floor((l.x0 - b.x0) / 360) as west, l.w as lw, b.w as bw
from l join b on l.y0 < b.y0 + b.t and b.y0 < l.y0 + l.t) select c_custkey, s_suppkey from d where east < lw or west < bw""")
def box_overlap(spark, sf_dir):
    """Tiles of customers and reaches of suppliers (grown by 0.25 degrees) that overlap; many cross the antimeridian."""
    k, s = c("c_custkey"), c("s_suppkey")
    tiles = table(spark, sf_dir, "customer").select(k, (k * 7 % 3600 / 10 - 180).alias("x0"), (k * 13 % 1500 / 10 - 75).alias("y0"), (0.1 + k % 37 / 10).alias("w"), (0.1 + k % 11 / 5).alias("t"))
    reaches = table(spark, sf_dir, "supplier").select(s, (s * 97 % 3600 / 10 - 180).alias("x0"), (s * 31 % 1500 / 10 - 75).alias("y0"), (0.5 + s % 9).alias("w"), (0.5 + s % 5).alias("t"))
    boxed = lambda d: d.withColumn("x1", c("x0") + c("w")).withColumn("y1", c("y0") + c("t")).drop("w", "t")
    return spatial.box_overlaps(boxed(tiles), spatial.buffered(boxed(reaches), 0.25), cell=2.0)


def _raster(spark, sf_dir):
    k = c("p_partkey")
    return table(spark, sf_dir, "part").select(F.floor(k / 40).alias("i"), (k % 40).alias("j"), (c("p_retailprice") + c("p_size")).alias("v"))


def _places(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (c("l_partkey") / 40 + c("l_discount")).alias("fi"), (c("l_partkey") % 41 + c("l_tax") * 9 - 0.5).alias("fj"))


_TAP_SQL = """with cells as (select p_partkey // 40 as i, p_partkey % 40 as j, p_retailprice + p_size as v from part), n as (select max(i) as n from cells),
p as (select l_orderkey, l_linenumber, l_partkey / 40 + l_discount as fi, l_partkey % 41 + l_tax * 9 - 0.5 as fj from lineitem),
q as (select *, floor(fi)::bigint as bi, floor(fj)::bigint as bj, fi - floor(fi) as u, fj - floor(fj) as t from p),
taps as (select *, unnest($AT) as a from q), pairs as (select *, unnest($AT) as b from taps),
w as (select l_orderkey, l_linenumber, fi, fj, n, $WI * $WJ as w, case when abs(bi + a) > n then 2 * n - abs(bi + a) else abs(bi + a) end as i, case when abs(bj + b) > 39 then 78 - abs(bj + b) else abs(bj + b) end as j from pairs, n where fi between 0 and n and fj between 0 and 39),
s as (select l_orderkey, l_linenumber, fi, fj, sum(w * v) as value from w join cells using (i, j) where w <> 0 group by 1, 2, 3, 4)
select l_orderkey, l_linenumber, round(coalesce(value, 0) / 7.3, 5) as value from p left join s using (l_orderkey, l_linenumber, fi, fj)"""
_SPLINE = """case {a} when -1 then pow(1 - {t}, 3) / 6 when 0 then (4 - 6 * {t} * {t} + 3 * pow({t}, 3)) / 6 when 1 then (4 - 6 * pow(1 - {t}, 2) + 3 * pow(1 - {t}, 3)) / 6 else pow({t}, 3) / 6 end"""
_NEAREST = "case when ({t} < 0.5) = ({a} = 0) then 1 else 0 end"
_LINEAR = "case {a} when 0 then 1 - {t} else {t} end"


def _taps(at: str, weight: str) -> str:
    return _TAP_SQL.replace("$AT", at).replace("$WI", weight.format(a="a", t="u")).replace("$WJ", weight.format(a="b", t="t"))


def _sampled(spark, sf_dir, order):
    cells = _raster(spark, sf_dir)
    rows = cells.agg(F.max("i")).first()[0] + 1
    out = spatial.sample_raster(_places(spark, sf_dir), cells, (rows, 40), order=order)
    return out.select("l_orderkey", "l_linenumber", r(c("value") / 7.3).alias("value"))


@query(_taps("[0, 1]", _NEAREST))
def raster_nearest(spark, sf_dir):
    return _sampled(spark, sf_dir, 0)


@query(_taps("[0, 1]", _LINEAR))
def raster_bilinear(spark, sf_dir):
    return _sampled(spark, sf_dir, 1)


@query(_taps("[-1, 0, 1, 2]", _SPLINE))
def raster_spline(spark, sf_dir):
    return _sampled(spark, sf_dir, 3)
