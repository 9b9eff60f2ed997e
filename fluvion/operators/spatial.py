"""Joins in two dimensions: overlapping boxes on the sphere, sampling of rasters, nearest labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo

BOX = ("x0", "y0", "x1", "y1")


def buffered(boxes: DataFrame, margin: float) -> DataFrame:
    """Boxes grown by margin on every side."""
    return boxes.withColumns({"x0": F.col("x0") - margin, "y0": F.col("y0") - margin, "x1": F.col("x1") + margin, "y1": F.col("y1") + margin})


def box_overlaps(left: DataFrame, right: DataFrame, cell: float = 1.0) -> DataFrame:
    """Pairs of boxes with a common inside, each once: the columns of both sides but the boxes.

    Boxes have columns x0, y0, x1, y1 in degrees. A box runs east from x0 to x1, so one with x1 west of x0 crosses the antimeridian;
    longitudes may be given in any turn. Each box is dealt to the cells that it touches in both axes (360 must be a multiple of
    cell), boxes of a cell are compared, and a pair is told in one cell alone: that of the south-west corner of what both have in common.
    Boxes with a null or with y1 below y0 overlap nothing.
    """
    columns = round(360 / cell)
    if abs(columns * cell - 360) > 1e-9:
        raise ValueError("360 must be a multiple of cell")

    def dealt(boxes: DataFrame, side: str) -> DataFrame:
        b = boxes.where("y1 >= y0 and x0 is not null and x1 is not null")
        own = [c for c in boxes.columns if c not in BOX]
        span = F.least(F.when(F.col("x1") - F.col("x0") >= 360, 360.0).otherwise(F.pmod(F.col("x1") - F.col("x0"), F.lit(360.0))), F.lit(360.0))
        b = b.select(*own, geo.wrap(F.col("x0")).alias(f"{side}x"), span.alias(f"{side}w"), F.col("y0").alias(f"{side}y"), F.col("y1").alias(f"{side}z"))
        first, last = F.floor(F.col(f"{side}x") / cell), F.floor((F.col(f"{side}x") + F.col(f"{side}w")) / cell)
        b = b.withColumn("_i", F.explode(F.sequence(first, F.least(last, first + columns - 1)))).withColumn("_i", F.pmod("_i", F.lit(columns)))
        return b.withColumn("_j", F.explode(F.sequence(F.floor(F.col(f"{side}y") / cell), F.floor(F.col(f"{side}z") / cell))))

    met = dealt(left, "_l").join(dealt(right, "_r"), ["_i", "_j"])
    right_begins = F.pmod(F.col("_rx") - F.col("_lx"), F.lit(360.0))  # how far east of left's west edge right begins
    left_begins = F.pmod(F.col("_lx") - F.col("_rx"), F.lit(360.0))
    inside_right = left_begins < F.col("_rw")
    met = met.where((inside_right | (right_begins < F.col("_lw"))) & (F.col("_ly") < F.col("_rz")) & (F.col("_ry") < F.col("_lz")))
    west = F.when(inside_right, F.col("_lx")).otherwise(F.col("_rx"))
    told = (F.col("_i") == F.pmod(F.floor(west / cell), F.lit(columns))) & (F.col("_j") == F.floor(F.greatest("_ly", "_ry") / cell))
    names = [c for side in (left, right) for c in side.columns if c not in BOX]
    return met.where(told).select(*names)


# Taps around the place below a point, by order of the interpolation: nearest, linear, cubic B-spline.
_TAPS = {0: (0, 1), 1: (0, 1), 3: (-1, 0, 1, 2)}


def _weights(order: int, t: Column) -> list[Column]:
    if order == 0:
        return [F.when(t < 0.5, 1.0).otherwise(0.0), F.when(t < 0.5, 0.0).otherwise(1.0)]
    if order == 1:
        return [1 - t, t]
    u = 1 - t
    return [u * u * u / 6, (4 - 6 * t * t + 3 * t * t * t) / 6, (4 - 6 * u * u + 3 * u * u * u) / 6, t * t * t / 6]


def _mirrored(k: str, n: int, halo: int) -> Column:
    """The places along an axis of n cells, up to halo beyond its ends, whose value is that of cell k: taps are mirrored at the ends."""
    other = 2 * (n - 1) - F.col(k)
    places = F.array_distinct(F.array(*(p.cast("long") for p in (F.col(k), -F.col(k), other, -other))))
    source = lambda g: F.when(F.abs(g) > n - 1, 2 * (n - 1) - F.abs(g)).otherwise(F.abs(g))
    return F.filter(places, lambda g: (source(g) == F.col(k)) & g.between(-halo, n - 1 + halo))


def raster_tiles(cells: DataFrame, shape: tuple[int, int], tile: int, halo: int = 2) -> DataFrame:
    """Cells (i, j, v) of a grid of that shape as tiles (ti, tj, values): rows of tile + 2 halo cells each way, row by row; null where the raster has none.

    A cell goes to its own tile and to the neighbours in whose halo it lies, and to the halo beyond the grid's ends where it is mirrored.
    """
    wide = tile + 2 * halo
    c = cells.select("i", "j", F.col("v").cast("double").alias("v"))
    for k, n in zip("ij", shape, strict=True):
        first, last = F.greatest(F.floor((F.col(f"g{k}") - halo) / tile), F.lit(0)), F.least(F.floor((F.col(f"g{k}") + halo) / tile), F.lit((n - 1) // tile))
        c = c.withColumn(f"g{k}", F.explode(_mirrored(k, n, halo))).withColumn(f"t{k}", F.explode(F.sequence(first, last)))
    local = {k: (F.col(f"g{k}") - F.col(f"t{k}") * tile + halo).cast("int") for k in "ij"}

    def filled(places: Column, values: Column, nothing: Column) -> Column:
        held = F.map_from_entries(F.collect_list(F.struct(places, values)))
        return F.transform(F.sequence(F.lit(0), F.lit(wide - 1)), lambda k: F.coalesce(F.element_at(held, k), nothing))

    # rows of a tile first, then the tile: a place is looked up among the cells of its row only
    rows = c.select("ti", "tj", local["i"].alias("li"), local["j"].alias("lj"), "v").repartition("ti", "tj").groupBy("ti", "tj", "li").agg(filled(F.col("lj"), F.col("v"), F.lit(None).cast("double")).alias("row"))
    nothing = F.array_repeat(F.lit(None).cast("double"), wide)
    return rows.groupBy("ti", "tj").agg(F.flatten(filled(F.col("li"), F.col("row"), nothing)).alias("values"))


def sample_raster(points: DataFrame, cells: DataFrame, shape: tuple[int, int], order: int = 1, tile: int = 16, outside: float | None = 0.0) -> DataFrame:
    """points with value: the raster (cells i, j, v of a grid of that shape) at their places (fi, fj), in cells.

    order 0 takes the nearest cell, 1 interpolates between four, 3 lays a cubic B-spline through the sixteen cells around as they stand (no
    prefilter). Places before the first or beyond the last cell get outside; near an edge missing taps are mirrored.
    Cells become tiles with a halo, so that all taps of a point lie in its tile, at fixed distances from its first; points meet tiles by key.
    A missing or null cell that has a weight makes the value null, as does a null place.
    """
    halo, wide = 2, tile + 4
    inside = F.lit(True)
    for k, n in zip("ij", shape, strict=True):
        inside = inside & F.col(f"f{k}").between(0, n - 1)
    p = points.withColumn("_inside", inside).withColumn("_bi", F.floor("fi")).withColumn("_bj", F.floor("fj"))
    away = -1 - F.pmod(F.xxhash64("fi", "fj"), F.lit(1009))  # places without a tile are spread over keys that no tile has
    p = p.withColumn("ti", F.when(F.col("_inside"), F.floor(F.col("_bi") / tile)).otherwise(away)).withColumn("tj", F.when(F.col("_inside"), F.floor(F.col("_bj") / tile)).otherwise(0))
    met = p.join(raster_tiles(cells, shape, tile, halo), ["ti", "tj"], "left")
    # Java leaves methods beyond 8000 bytes uncompiled: so weights and the place below are columns of their own, never null (places that are null
    # have no value in any case), and only weights that can vanish are asked
    below = F.coalesce(((F.col("_bi") - F.col("ti") * tile + halo) * wide + F.col("_bj") - F.col("tj") * tile + halo).cast("int"), F.lit(0))
    names = {k: [f"_w{k}{a}" for a in range(len(_TAPS[order]))] for k in "ij"}
    met = met.withColumns({"_below": below} | {name: w for k in "ij" for name, w in zip(names[k], _weights(order, F.coalesce(F.col(f"f{k}") - F.col(f"_b{k}"), F.lit(0.0))), strict=True)})
    value, last = F.lit(0.0), _TAPS[order][-1]
    for a, wi in zip(_TAPS[order], names["i"], strict=True):
        for b, wj in zip(_TAPS[order], names["j"], strict=True):
            weight = F.col(wi) * F.col(wj)
            term = weight * F.get("values", F.col("_below") + (a * wide + b))
            value = value + (F.when(weight == 0, 0.0).otherwise(term) if a == last or b == last or order == 0 else term)
    return met.withColumn("value", F.when(F.col("_inside"), value).when(~F.col("_inside"), F.lit(outside).cast("double"))).select(*points.columns, "value")
