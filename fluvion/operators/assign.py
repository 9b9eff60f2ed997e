"""Which reach a pixel belongs to: labels, channels and exchange between neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import fits, joins


def in_channel(s: Column, n: Column, max_width: Column, node_length: Column) -> Column:
    return (F.abs(n) <= max_width / 2) & (F.abs(s) <= 3 * node_length)


def extended(s: Column, n: Column, max_width: Column, node_length: Column, factor: Column | float = 20.0) -> Column:
    """The farther bound within which pixels of the dominant label still count."""
    bound = factor * F.greatest(node_length, max_width / 2)
    return (F.abs(n) <= bound) & (F.abs(s) <= bound)


def with_dominant_label(rows: DataFrame, key: list[str], label: str, channel: Column, far: Column) -> DataFrame:
    """Channel pixels, and pixels within the far bound whose label is the channel's most frequent positive one.

    A reach without a positive label in its channel loses all its pixels.
    """
    main = joins.dominant_label(rows.where(channel), key, label).select(*key, F.col(label).alias("_main"))
    return rows.join(main, key).where(channel | (far & (F.col(label) == F.col("_main")))).drop("_main")


def exchanged_labels(rows: DataFrame, neighbours: DataFrame, reach: str, label: str) -> DataFrame:
    """Second pass: labels that dominate a neighbouring reach count as the reach's own. neighbours: (reach, neighbour).

    Adds own (the reach's dominant label, null if it has none) and the new label.
    """
    main = joins.dominant_label(rows, [reach], label).select(F.col(reach).alias("_r"), F.col(label).alias("_l"))
    near = neighbours.join(main, F.col("neighbour") == F.col("_r")).select(F.col(reach), F.col("_l").alias(label)).distinct().withColumn("_near", F.lit(True))
    own = main.select(F.col("_r").alias(reach), F.col("_l").alias("own"))
    out = rows.join(own, reach, "left").join(near, [reach, label], "left")
    return out.withColumn(label, F.when(F.col("_near") & F.col("own").isNotNull(), F.col("own")).otherwise(F.col(label))).drop("_near")


def blocking_width(vertices: DataFrame, key: list[str], order: str, x: str = "x", y: str = "y", reach: int = 3) -> DataFrame:
    """The signed radius of the circle through a vertex and one up to reach places before and after it; the smallest by absolute value, null on straight lines and at the ends."""
    w = Window.partitionBy(*key).orderBy(order)
    found = []
    for a in range(1, reach + 1):
        for b in range(1, reach + 1):
            ax, ay, bx, by = F.lag(x, a).over(w), F.lag(y, a).over(w), F.lead(x, b).over(w), F.lead(y, b).over(w)
            twice = (F.col(x) - ax) * (by - ay) - (F.col(y) - ay) * (bx - ax)
            sides = F.hypot(F.col(x) - ax, F.col(y) - ay) * F.hypot(bx - F.col(x), by - F.col(y)) * F.hypot(bx - ax, by - ay)
            radius = sides / (2 * F.nullif(twice, F.lit(0.0)))
            found.append(F.when(radius.isNotNull(), F.struct(F.abs(radius).alias("size"), radius.alias("radius"))))
    return vertices.withColumn("blocking", F.array_min(F.array_compact(F.array(*found)))["radius"])


def flow_gradient(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """Least-squares gradient of z over the plane, from covariances."""
    xx, yy, xy, xz, yz = F.var_pop(x), F.var_pop(y), F.covar_pop(x, y), F.covar_pop(x, z), F.covar_pop(y, z)
    d = F.nullif(xx * yy - xy * xy, F.lit(0.0))
    return (xz * yy - yz * xy) / d, (yz * xx - xz * xy) / d


def neighbour_filter(rows: DataFrame, gap: float = 1000.0) -> DataFrame:
    """Stitched nodes with good once more: reach_id, part (-1, 0, 1), ss, node_q, good.

    Nodes of neighbours must not be bad (node_q of 3). Between neighbouring good nodes a distance beyond gap is a gap. Beyond the nearest gap that begins
    among the downstream neighbour's nodes, these are not good; from the first one that begins among the upstream neighbour's on, those are not.
    The reach's own nodes keep what they are. A reach and its neighbours are some hundred rows.
    """
    kept = F.col("good") & ((F.col("part") == 0) | (F.col("node_q") < 3))
    w = Window.partitionBy("reach_id").orderBy("ss", "part", "node_id")
    rows = rows.withColumn("good", F.coalesce(kept, F.lit(False)))
    following = F.first(F.when(F.col("good"), F.col("ss")), True).over(w.rowsBetween(1, Window.unboundedFollowing))
    rows = rows.withColumn("_gap", F.col("good") & (following - F.col("ss") > gap)).withColumn("_k", F.row_number().over(w))
    whole = Window.partitionBy("reach_id")
    down = F.max(F.when(F.col("_gap") & (F.col("part") == -1), F.col("_k"))).over(whole)
    up = F.min(F.when(F.col("_gap") & (F.col("part") == 1), F.col("_k"))).over(whole)
    beyond = F.coalesce(F.col("_k") <= down, F.lit(False)) | F.coalesce(F.col("_k") >= up, F.lit(False))
    return rows.withColumn("good", F.col("good") & ~beyond).drop("_gap", "_k")


def coarse_good(nodes: DataFrame, low: float = -1000.0, high: float = 100_000.0, per_km: float = 10.0, least: float = 20.0, min_points: int = 3) -> DataFrame:
    """nodes (reach_id, s, wse, wse_u) with valid and good. valid: wse between low and high, and a weight above 0.

    good are valid nodes near the reach's weighted line: within per_km times its height change over a kilometre, or least if that is less. In reaches of at most
    min_points valid nodes all of these are good.
    """
    weight = 1 / F.nullif(F.col("wse_u") * F.col("wse_u"), F.lit(0.0))
    rows = nodes.withColumn("_w", weight).withColumn("valid", F.coalesce((F.col("wse") > low) & (F.col("wse") < high) & (F.col("_w") > 0), F.lit(False)))
    line = fits.weighted_line(rows.where("valid"), ["reach_id"], "s", "wse", "_w")
    rows = rows.join(line, "reach_id", "left")
    off = F.abs(F.col("wse") - F.col("slope") * F.col("s") - F.col("intercept"))
    near = (F.col("n") <= min_points) | F.col("slope").isNull() | (off < F.greatest(F.abs("slope") * 1000 * per_km, F.lit(least)))
    return rows.select(*nodes.columns, "valid", (F.col("valid") & F.coalesce(near, F.lit(False))).alias("good"))
