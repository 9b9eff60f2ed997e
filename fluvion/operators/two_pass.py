"""Pixels to reaches in two passes: labels and widths of the first bound the search of the second, then each pixel keeps one reach."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import written
from . import assign, network, rings

#: Reaches of at most so many nodes give no labels.
SHORT = 3


def search_widths(nodes: DataFrame) -> DataFrame:
    """nodes with half_width: how far from the line a pixel may always lie in the second pass.

    It is the larger of max_width and width, with the reach's median for missing and then for non-positive ones, times wth_coef.
    """
    wide = F.when(F.isnan("max_width") | F.isnan("width") | F.col("max_width").isNull() | F.col("width").isNull(), None).otherwise(F.greatest("max_width", "width"))
    rows = nodes.withColumn("_wide", wide)
    fill = rows.groupBy("reach_id").agg(F.median("_wide").alias("_fill"))
    rows = rows.join(fill.hint("merge"), "reach_id").withColumn("_wide", F.coalesce("_wide", "_fill"))
    again = rows.groupBy("reach_id").agg(F.median("_wide").alias("_fill"))
    rows = rows.drop("_fill").join(again.hint("merge"), "reach_id")
    return rows.withColumn("half_width", F.when(F.col("_wide") <= 0, F.col("_fill")).otherwise(F.col("_wide")) * F.col("wth_coef")).drop("_wide", "_fill")


def _offsets() -> tuple[Column, Column]:
    """Along and across the line, from the node."""
    dx, dy = F.col("x") - F.col("nx"), F.col("y") - F.col("ny")
    return dx * F.col("tx") + dy * F.col("ty"), dy * F.col("tx") - dx * F.col("ty")


def _in_channels(pixels: DataFrame, nodes: DataFrame, halves: list[str]) -> DataFrame:
    """pixel_id, reach_id, label of the pixels in a channel of a reach, by the reach's nearest node, and whether they are in that of each of halves.

    Reaches search as far as their own widths ask for; all channels are told in one search, for which pixels are shuffled once.
    """
    far = F.hypot(F.greatest(*halves) if len(halves) > 1 else F.col(halves[0]), 3 * F.col("spacing"))
    level = F.ceil(F.log2(F.greatest(F.max(far), F.lit(1.0))))
    levels = nodes.groupBy("reach_id").agg(level.alias("level"))
    nodes = nodes.join(levels.hint("merge"), "reach_id")
    columns = ["node_id", "nx", "ny", "tx", "ty", "spacing", *halves]
    out = None
    for k in sorted(r.level for r in levels.select("level").distinct().collect()):  # powers of two: some ten at most
        best = rings.nearest_within_cell(pixels, nodes.where(F.col("level") == k).select("reach_id", *columns), float(2**k), columns, group="reach_id")
        best = best.select("pixel_id", "reach_id", "x", "y", "label", "b.*")
        s, n = _offsets()
        inside = [((F.abs(n) <= F.col(h)) & (F.abs(s) <= 3 * F.col("spacing"))).alias(f"in_{h}") for h in halves]
        found = best.select("pixel_id", "reach_id", "label", *(F.coalesce(i, F.lit(False)).alias(f"in_{h}") for i, h in zip(inside, halves, strict=True)))
        found = found.where(" or ".join(f"in_{h}" for h in halves))
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = pixels.select("pixel_id", F.lit(None).cast(nodes.schema["reach_id"].dataType).alias("reach_id"), "label", *(F.lit(False).alias(f"in_{h}") for h in halves)).where("false")
    return out


def _main_labels(counts: DataFrame) -> DataFrame:
    """reach_id, main: the most frequent positive label, the least on ties, from counts (reach_id, label, n)."""
    sums = counts.where("label > 0").groupBy("reach_id", "label").agg(F.sum("n").alias("n"))
    return sums.groupBy("reach_id").agg(F.min(F.struct((-F.col("n")).alias("n"), "label")).alias("m")).select("reach_id", F.col("m.label").alias("main"))


def assign_reaches(pixels: DataFrame, nodes: DataFrame, neighbours: DataFrame, max_width: float = 600.0, min_obs: int = 10, use_ext_dist_coef: bool = False) -> DataFrame:
    """pixel_id, reach_id, node_id, d, s, n of each pixel that belongs to a reach.

    pixels: pixel_id, x, y, label (0 for none). nodes: reach_id, node_id, x, y, tx, ty (unit tangent), spacing, width, max_width,
    wth_coef, ext_dist_coef. neighbours: reach_id, neighbour.

    1. Pixels within max_width / 2 of the line and three spacings of the reach's nearest node are in its channel; their most frequent positive label
       (the least on ties) is the reach's, for reaches of more than three nodes.
    2. For a reach, labels of its neighbours count as its own. Channels are laid again with a width for each node (search_widths), and so is
       each reach's label. Pixels with it also belong to the reach up to twenty times the larger of spacing and half width, along and across. A
       reach without a positive label in its channel has no pixels.
    3. A pixel may only belong to a reach that its nearest node of all belongs to; of several the last by reach_id. The nearest nodes are
       found by growing rings, for pixels in a channel or with a label that a reach has.
    4. With use_ext_dist_coef, pixels of extended reaches stay up to ext_dist_coef times the larger of spacing and half width, in all parts.
    5. Ghost reaches (id ends in 6), those of one node, and those without a node of min_obs pixels go.

    Joins of nodes and reaches are told not to broadcast, as both grow with the river and their files are small for their rows.
    """
    nodes = written(search_widths(nodes).withColumns({"nx": F.col("x"), "ny": F.col("y"), "scalar_half": F.lit(max_width / 2)}).drop("x", "y"), "pass-nodes")
    pixels = pixels.select("pixel_id", "x", "y", "label")
    counts = nodes.groupBy("reach_id").agg(F.count("*").alias("n_nodes"))

    channels = written(_in_channels(pixels, nodes, ["scalar_half", "half_width"]), "pass-channels")
    counted = channels.groupBy("reach_id", "label").agg(F.count_if("in_scalar_half").alias("first"), F.count_if("in_half_width").alias("n"))
    counted = written(counted, "pass-counts")
    first = _main_labels(counted.where("first > 0").select("reach_id", "label", F.col("first").alias("n"))).join(counts.where(F.col("n_nodes") > SHORT).hint("merge"), "reach_id", "left_semi")
    first = written(first, "pass-labels")
    # which labels count as a reach's own: those of neighbours are read as the reach's
    near = neighbours.join(first.select(F.col("reach_id").alias("neighbour"), F.col("main").alias("label")).hint("merge"), "neighbour").select("reach_id", "label").distinct()
    renamed = near.join(first.hint("merge"), "reach_id").select("reach_id", "label", F.col("main").alias("renamed"))
    seen = counted.where("n > 0").join(renamed.hint("merge"), ["reach_id", "label"], "left").select("reach_id", F.coalesce("renamed", "label").alias("label"), "n")
    second = written(_main_labels(seen), "pass-mains")

    # labels of pixels that make them part of a reach beyond its channel: its own, if no neighbour's reading changes it, and those read as it
    changed = renamed.select("reach_id", F.col("label").alias("main")).withColumn("away", F.lit(True))
    own = second.join(changed.hint("merge"), ["reach_id", "main"], "left").join(first.withColumnRenamed("main", "first").hint("merge"), "reach_id", "left").where(F.col("away").isNull() | (F.col("first") == F.col("main")))
    labels = own.select("reach_id", F.col("main").alias("label")).unionByName(renamed.join(second.hint("merge"), (renamed.reach_id == second.reach_id) & (renamed.renamed == second.main)).select(renamed.reach_id, "label")).distinct()
    labels = written(labels, "pass-far-labels")

    inside = channels.where("in_half_width").select("pixel_id").distinct().withColumn("_in", F.lit(True))
    asked = pixels.join(inside.hint("merge"), "pixel_id", "left").join(labels.select("label").distinct().withColumn("_far", F.lit(True)), "label", "left")
    asked = asked.where(F.col("_in") | F.col("_far")).select("pixel_id", "x", "y", "label")
    reach = nodes.agg(F.max(20 * F.greatest("spacing", "half_width")).alias("far"), F.max(F.hypot(F.col("half_width"), 3 * F.col("spacing"))).alias("near"), F.avg("spacing").alias("spacing")).first()
    # nodes tell their reach's far labels (null without a label in the channel) and size, so that pixels meet these with their node
    known = second.select("reach_id").join(labels.groupBy("reach_id").agg(F.collect_list("label").alias("mains")).hint("merge"), "reach_id", "left").withColumn("mains", F.coalesce("mains", F.array().cast(T.ArrayType(labels.schema["label"].dataType))))
    columns = ["reach_id", "node_id", "nx", "ny", "tx", "ty", "spacing", "half_width", "ext_dist_coef", "n_nodes", "mains"]
    searched = written(nodes.join(counts.hint("merge"), "reach_id").join(known.hint("merge"), "reach_id", "left").select(*columns), "pass-searched")
    closest = rings.nearest(asked, searched, "pixel_id", max(reach.spacing or 0.0, 1.0), max(math.hypot(reach.far or 0.0, reach.far or 0.0), reach.near or 0.0), group="reach_id", carried=["label", "x", "y"])

    s, n = _offsets()
    rows = closest.withColumns({"s": s, "n": n}).where("mains is not null")
    wide = F.greatest("spacing", "half_width")
    channel = (F.abs("n") <= F.col("half_width")) & (F.abs("s") <= 3 * F.col("spacing"))
    rows = rows.where(channel | (F.array_contains("mains", F.col("label")) & assign.extended(F.col("s"), F.col("n"), 2 * F.col("half_width"), F.col("spacing"))))
    best = F.max(F.struct("reach_id", "node_id", F.sqrt("d2").alias("d"), "s", "n", (F.col("ext_dist_coef") * wide).alias("bound"), "n_nodes")).alias("b")
    rows = rows.groupBy("pixel_id").agg(best).select("pixel_id", "b.*").where((F.col("n_nodes") > 1) & (F.col("reach_id") % 10 != network.GHOST))
    rows = populated(written(rows, "pass-rows"), min_obs)  # read twice
    if use_ext_dist_coef:
        rows = populated(rows.where((F.abs("s") <= F.col("bound")) & (F.abs("n") <= F.col("bound"))), min_obs)
    return rows.select("pixel_id", "reach_id", "node_id", "d", "s", "n")


def populated(rows: DataFrame, min_obs: int) -> DataFrame:
    """The pixels of reaches that have a node of at least min_obs pixels."""
    full = rows.groupBy("reach_id", "node_id").count().where(F.col("count") >= min_obs).select("reach_id").distinct()
    return rows.join(full, "reach_id", "left_semi")
