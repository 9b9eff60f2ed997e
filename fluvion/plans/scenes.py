"""Queries on many scenes: pruned scans, unequal schemas, bad scenes, exact percentiles of few keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quantiles
from ..sources import scenes
from ..sources.scratch import folder
from .catalogue import c, query, r, table

_TILE = """lower(format('{}{:03d}{}{:02d}', case when c_custkey % 36 < 18 then 'W' else 'E' end, abs(c_custkey % 36 - 18) * 10, case when c_nationkey < 12 then 's' else 'n' end, abs(c_nationkey - 12)))"""


def _tile():
    k, n = c("c_custkey") % 36, c("c_nationkey")
    return F.lower(F.format_string("%s%03d%s%02d", F.when(k < 18, "W").otherwise("E"), F.abs(k - 18) * 10, F.when(n < 12, "s").otherwise("n"), F.abs(n - 12)))


@query(f"""with t as (select distinct {_TILE} as tile, (c_custkey % 36 - 18) * 10.0 as x, c_nationkey - 12.0 as y from customer)
select tile || '_cycle_1_pass_1.nc' as name, x as x0, y as y0, x + 10 as x1, y + 1 as y1, format('POLYGON (({{:.6f}} {{:.6f}}, {{:.6f}} {{:.6f}}, {{:.6f}} {{:.6f}}, {{:.6f}} {{:.6f}}, {{:.6f}} {{:.6f}}))', x + 10, y, x + 10, y + 1, x, y + 1, x, y, x + 10, y) as polygon from t""")
def coverage_catalogue(spark, sf_dir):
    """Boxes and polygons decoded from the names of tiles."""
    names = table(spark, sf_dir, "customer").select(F.concat(_tile(), F.lit("_cycle_1_pass_1.nc")).alias("name")).distinct()
    return scenes.coverage(names, dlon=10.0)


@query("""select c_custkey, c_nationkey from customer where (c_custkey % 36 - 18) * 10 in (160, 170, -180, -170) and c_nationkey - 12 between -3 and 2""")
def pruned_scan(spark, sf_dir):
    """Customers written as a file for each tile; only the files that overlap a box across the antimeridian are read."""
    path = f"{folder(spark)}/tiles-{spark.sparkContext.applicationId}-{abs(hash(sf_dir))}"
    tiles = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", _tile().alias("tile"))
    tiles.repartition("tile").write.mode("overwrite").partitionBy("tile").parquet(path)
    files = scenes.files_of(spark, path).where("name like '%.parquet'").withColumn("name", F.regexp_extract("path", "tile=([^/]+)/", 1))
    return scenes.read_overlapping(spark, scenes.coverage(files, dlon=10.0), (165.0, -2.5, -165.0, 2.5)).select("c_custkey", "c_nationkey")


@query("""with t as (select l_suppkey % 40 as scene, l_suppkey as reach, list_sort(list(distinct l_linenumber::int)) as codes, sum(l_quantity) as area, min(l_tax) as tax, max(l_discount) as disc from lineitem group by l_suppkey),
b as (select scene, case when min(tax) is null then 'no tax' when sum(area) < 1000 then 'small' when count(*) filter (where reach % 13 = 5) > 0 then 'reach' end as reason from t group by 1), g as (select t.* from t join b using (scene) where reason is null), m as (select max(len(codes)) as m from g)
select scene, reach, list_resize(codes, m) as codes, area, case when scene % 2 = 0 then tax end as tax, case when scene % 2 = 1 then disc end as disc from g, m""")
def merged_scenes(spark, sf_dir):
    """Scenes with unequal columns and ragged lists in one table, without the bad ones."""
    t = table(spark, sf_dir, "lineitem").groupBy(c("l_suppkey").alias("reach")).agg(F.array_sort(F.collect_set(c("l_linenumber").cast("int"))).alias("codes"), F.sum("l_quantity").alias("area"), F.min("l_tax").alias("tax"), F.max("l_discount").alias("disc"))
    t = t.withColumn("scene", c("reach") % 40)
    good, _ = scenes.put_aside(t, "scene", {"no tax": F.min("tax").isNull(), "small": F.sum("area") < 1000, "reach": F.count_if(c("reach") % 13 == 5) > 0})
    both = scenes.merged([good.where("scene % 2 = 0").select("scene", "reach", "codes", "area", "tax"), good.where("scene % 2 = 1").select("scene", "reach", "codes", "area", "disc")])
    return scenes.padded(both)


@query("""with t as (select l_suppkey % 40 as scene, l_suppkey as reach, sum(l_quantity) as area, min(l_tax) as tax from lineitem group by l_suppkey)
select scene, case when min(tax) is null then 'no tax' when sum(area) < 1000 then 'small' when count(*) filter (where reach % 13 = 5) > 0 then 'reach' end as reason, count(*) as n from t group by 1 having reason is not null""")
def bad_scenes(spark, sf_dir):
    """The scenes put aside, with the reason."""
    t = table(spark, sf_dir, "lineitem").groupBy(c("l_suppkey").alias("reach")).agg(F.sum("l_quantity").alias("area"), F.min("l_tax").alias("tax")).withColumn("scene", c("reach") % 40)
    return scenes.put_aside(t, "scene", {"no tax": F.min("tax").isNull(), "small": F.sum("area") < 1000, "reach": F.count_if(c("reach") % 13 == 5) > 0})[1]


@query("select l_returnflag, count(*) as n, round(quantile_cont(l_extendedprice / 997, 0.02), 5) as p2, round(quantile_cont(l_extendedprice / 997, 0.5), 5) as p50, round(quantile_cont(l_extendedprice / 997, 0.68), 5) as p68 from lineitem group by 1")
def few_key_percentiles(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", (c("l_extendedprice") / 997).alias("h"))
    return quantiles.percentiles(rows, ["l_returnflag"], "h", {"p2": 0.02, "p50": 0.5, "p68": 0.68}).select("l_returnflag", "n", *(r(k).alias(k) for k in ("p2", "p50", "p68")))
