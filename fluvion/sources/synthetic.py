"""A straight synthetic river with a known slope, by rule from ranges: no random state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLOPE, BASE, SPACING, PER_REACH = 1e-4, 100.0, 200.0, 20


def vertices(spark: SparkSession, reaches: int = 3) -> DataFrame:
    k = F.col("id")
    return spark.range(reaches * PER_REACH).select(k.alias("vertex_id"), (F.floor(k / PER_REACH) * 10 + 11).alias("reach_id"), (k % PER_REACH).alias("node_id"), (k * SPACING).alias("x"), F.lit(0.0).alias("y"), F.lit(1.0).alias("tx"), F.lit(0.0).alias("ty"))


def prior_nodes(spark: SparkSession, reaches: int = 3, unobserved: int = 1) -> DataFrame:
    return vertices(spark, reaches + unobserved).select("reach_id", "node_id", F.lit(SPACING).alias("node_length"))


def pixels(spark: SparkSession, reaches: int = 3, step: float = 20.0, outlier: int | None = 7) -> DataFrame:
    """A grid along the river; beyond 40 m across the class is an edge; node outlier of the first reach is 40 m too high."""
    across = int(120 / step) + 1
    along = int(reaches * PER_REACH * SPACING / step)
    k = F.col("id")
    x, y = F.floor(k / across) * step - SPACING / 2 + 1, (k % across) * step - 60
    rows = spark.range(along * across).select(k.alias("point_id"), x.alias("x"), y.alias("y"))
    node = F.round(F.col("x") / SPACING)
    height = BASE + SLOPE * node * SPACING + (F.when(node == outlier, 40.0).otherwise(0.0) if outlier is not None else 0.0)
    edge = F.abs("y") > 40
    return (
        rows.withColumn("height", height)
        .withColumn("sigma", F.when(F.col("point_id") % 2 == 0, 0.1).otherwise(0.5))
        .withColumn("klass", F.when(edge, 3).otherwise(4))
        .withColumn("water_frac", F.when(edge, 0.5).otherwise(1.0))
        .withColumn("pixel_area", F.lit(step * step))
        .withColumn("degraded", F.col("point_id") % 97 == 0)
    )
