"""Pixels to river nodes and reaches on one plan; the README says which steps the chain leaves out."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import quality
from ..operators import aggregates as A
from ..operators import assign as channel
from ..operators import fits, joins

#: Pixels farther than this across the flow (m) belong to no node: half the default width of the channel, 600 m.
MAX_CROSS = 300.0


def assign(pixels: DataFrame, vertices: DataFrame, spacing: float, max_cross: float = MAX_CROSS) -> DataFrame:
    """Each pixel with its nearest vertex and s and n offsets, within the channel and of exactly one reach."""
    met = joins.nearest_vertex(pixels.select("point_id", "x", "y"), vertices, cell=math.hypot(max_cross, 3 * spacing))
    near = met.where(channel.in_channel(F.col("s"), F.col("n"), F.lit(2 * max_cross), F.lit(spacing)))
    return pixels.join(near, "point_id").join(vertices.select("vertex_id", "reach_id", "node_id"), "vertex_id")


def nodes(assigned: DataFrame, min_pixels: int = 3) -> DataFrame:
    """One row a node: heights from good pixels, from all if too few are good, areas and the quality flag."""
    good = (F.col("klass").isin(*A.INTERIOR, *A.WATER_EDGE)) & ~F.col("degraded")
    h = F.col("height")
    g = assigned.groupBy("reach_id", "node_id").agg(
        F.count("*").alias("n_pix"), A.count(good).alias("n_good"), A.weighted_mean(h, F.col("sigma"), good).alias("wse_good"), A.weighted_mean(h, F.col("sigma")).alias("wse_all"),
        (1 / F.sqrt(F.sum(1 / (F.col("sigma") * F.col("sigma"))))).alias("wse_u"), A.area(F.col("pixel_area"), F.col("water_frac"), F.col("klass")).alias("area"), A.detected_area(F.col("pixel_area"), F.col("water_frac"), F.col("klass")).alias("area_detected"),
    )
    wse = F.when(F.col("n_good") >= min_pixels, F.col("wse_good")).otherwise(F.col("wse_all"))
    flag = quality.flag({"few_wse": F.col("n_good") < min_pixels, "class_degraded": F.col("n_good") == 0})
    return g.select("reach_id", "node_id", "n_pix", "n_good", wse.alias("wse"), "wse_u", "area", "area_detected", flag.alias("node_flag"))


def reaches(node_rows: DataFrame, prior_nodes: DataFrame) -> DataFrame:
    """One row a reach: outliers are masked, a weighted line gives height and slope at the reach's middle; every prior reach has a row."""
    placed = fits.flow_distance(prior_nodes, ["reach_id"], ["node_id"], "node_length")
    all_nodes = placed.join(node_rows, ["reach_id", "node_id"], "left")
    mask = fits.linear_outliers(all_nodes)
    used = all_nodes.join(mask, ["reach_id", "node_id"])
    ok = F.col("good")
    slope, height = A.line(F.col("s"), A.only(F.col("wse"), ok), A.only(1 / (F.col("wse_u") * F.col("wse_u")), ok))
    length = F.sum(F.when(F.col("n_pix") > 0, F.col("node_length")))
    out = used.groupBy("reach_id").agg(
        slope.alias("slope"), height.alias("wse"), A.count(ok).alias("n_good_nod"), (A.count(F.col("n_pix") > 0) / F.count("*")).alias("obs_frac"), (F.sum("area") / length).alias("width"), F.coalesce(F.bit_or(A.only(F.col("node_flag"), ok)), F.lit(0)).alias("reach_flag")
    )
    return out.withColumn("reach_q", F.when(F.col("slope").isNull(), 3).otherwise(quality.summary(F.col("reach_flag"))))
