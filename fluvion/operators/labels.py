"""Labels of connected water over whole rasters: components by blocks and borders, erosion and reattachment by counted neighbours."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from . import graph, rings

#: Cells of a block's side: a task labels one block at a time.
BLOCK = 128
CELL = ["az", "rg"]
#: A cell's key orders cells as a scan does, row by row; rows and columns are not negative.
_ROW = 1 << 31


def key() -> Column:
    return F.col("az") * _ROW + F.col("rg")


def moved(cells: DataFrame, offsets: list[tuple[int, int]]) -> DataFrame:
    """Every cell once at each offset."""
    steps = F.explode(F.array(*(F.struct((F.col("az") + i).alias("az"), (F.col("rg") + j).alias("rg")) for i, j in offsets)))
    rest = [c for c in cells.columns if c not in CELL]
    return cells.select(*rest, steps.alias("_c")).select(*rest, "_c.az", "_c.rg")


def diamond(n: int) -> list[tuple[int, int]]:
    """Offsets at most n steps away, along rows and columns."""
    return [(i, j) for i in range(-n, n + 1) for j in range(-n, n + 1) if abs(i) + abs(j) <= n]


def square(n: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(-n, n + 1) for j in range(-n, n + 1)]


def dilated(cells: DataFrame, n: int) -> DataFrame:
    """Cells at most n steps from one of cells, not before the raster's first row and column."""
    return moved(cells.select(*CELL), diamond(n)).where("az >= 0 and rg >= 0").distinct() if n else cells.select(*CELL).distinct()


def eroded(cells: DataFrame, n: int) -> DataFrame:
    """Cells whose whole neighbourhood of n steps is in cells: each tells its neighbours, who count."""
    shape = diamond(n)
    return moved(cells.select(*CELL).distinct(), shape).groupBy(*CELL).count().where(F.col("count") == len(shape)).select(*CELL)


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Puts a[k] and b[k] into one set, for all k; root tells the least of each set."""
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while not np.array_equal(shorter := root[root], root):
            root[:] = shorter


def _blocks(i: np.ndarray, j: np.ndarray, az: np.ndarray, rg: np.ndarray, block: int) -> pa.RecordBatch:
    """az, rg, part of the cells of whole blocks (i, j), sorted by them: all blocks at once. Repeated cells are one."""
    first = np.concatenate(([True], (np.diff(i) != 0) | (np.diff(j) != 0)))
    keys, at = np.unique((np.cumsum(first) - 1) * block * block + (az - i * block) * block + rg - j * block, return_index=True)
    az, rg = az[at], rg[at]
    run = np.cumsum(np.concatenate(([0], (np.diff(keys) != 1) | (keys[1:] % block == 0))))  # cells next to each other in a row of a block
    above = np.minimum(np.searchsorted(keys, keys - block), len(keys) - 1)
    met = (keys[above] == keys - block) & (keys // block % block > 0)
    root = np.arange(run[-1] + 1)
    _joined(root, run[met], run[above[met]])
    start = np.searchsorted(run, root)[run]  # the first cell of the part
    return pa.record_batch({"az": az, "rg": rg, "part": az[start] * _ROW + rg[start]})


def _labelled(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Blocks come whole and sorted; a call labels those that end in a batch."""
    held: list[pa.RecordBatch] = []

    def columns(parts: list[pa.RecordBatch]) -> list[np.ndarray]:
        table = pa.Table.from_batches(parts)
        return [table[k].to_numpy() for k in ("_i", "_j", "az", "rg")]

    for batch in batches:
        if not len(batch):
            continue
        i, j = batch.column("_i").to_numpy(), batch.column("_j").to_numpy()
        last = int(np.flatnonzero((i != i[-1]) | (j != j[-1])).max(initial=-1)) + 1  # the last block may go on in the next batch
        if held and (held[-1].column("_i")[0].as_py(), held[-1].column("_j")[0].as_py()) != (i[0], j[0]):
            yield _blocks(*columns(held), block)
            held = []
        if last:
            yield _blocks(*columns([*held, batch.slice(0, last)]), block)
            held = []
        held.append(batch.slice(last))
    if held:
        yield _blocks(*columns(held), block)


def components(cells: DataFrame, block: int = BLOCK) -> DataFrame:
    """az, rg, part: the key of the first cell, in scan order, of each cell's 4-connected component.

    Each block of cells is labelled in a task, many blocks in a call of Python, by runs in their rows. Cells on two sides of a block's border tell which parts belong together; the graph of
    these parts, not of cells, gives the components. Repeated cells are one.
    """
    dealt = cells.select(F.col("az").cast("long").alias("az"), F.col("rg").cast("long").alias("rg")).where("az is not null and rg is not null")
    blocks = dealt.withColumn("_i", F.floor(F.col("az") / block)).withColumn("_j", F.floor(F.col("rg") / block))
    sorted_blocks = blocks.repartition("_i", "_j").sortWithinPartitions("_i", "_j")
    own = written(sorted_blocks.mapInArrow(lambda batches: _labelled(batches, block), "az long, rg long, part long"), "labels-blocks")
    edges = None
    for side, other in (("az", "rg"), ("rg", "az")):
        last = own.where(F.col(side) % block == block - 1).select((F.col(side) + 1).alias(side), other, F.col("part").alias("a"))
        met = last.join(own.where(F.col(side) % block == 0).select(side, other, F.col("part").alias("b")), [side, other]).select("a", "b")
        edges = met if edges is None else edges.unionByName(met)
    whole = graph.components(edges.distinct())
    return own.join(whole.withColumnRenamed("node", "part"), "part", "left").select(*CELL, F.coalesce("component", "part").alias("part"))


def numbered(parts: DataFrame, column: str = "part") -> DataFrame:
    """(column, number): the distinct values, numbered from 1 in order. Ranges of values are counted first, so no task sorts them all."""
    values = parts.select(column).distinct()
    ranged = written(values.repartitionByRange(F.col(column)).withColumn("_range", F.spark_partition_id()), "labels-ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").count().withColumn("_start", F.coalesce(F.sum("count").over(before), F.lit(0)))  # one row for each range
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(column))
    return ranged.join(F.broadcast(starts), "_range").select(column, (F.col("_start") + rank).alias("number"))


def water_labels(pixels: DataFrame, dilation: int = 0, block: int = BLOCK) -> DataFrame:
    """az, rg, label of pixels (az, rg, is_water): water by its 4-connected component, numbered in scan order, others by the largest label around.

    With dilation, water at most twice so many steps apart has one label. A pixel without water has the largest label in the 3 x 3 pixels around it, 0
    if there is none. Repeated pixels are one, and water if one of them is.
    """
    pixels = pixels.groupBy(*CELL).agg(F.max("is_water").alias("is_water"))
    parts = written(components(dilated(pixels.where("is_water"), dilation), block), "labels-parts")
    labelled = parts.join(numbered(parts), "part").select(*CELL, F.col("number").alias("label"))
    own = pixels.join(labelled, CELL, "left")
    around = moved(own.where("label is null").select(*CELL, F.col("az").alias("_az"), F.col("rg").alias("_rg")), square(1)).join(labelled, CELL)
    near = around.groupBy(F.col("_az").alias("az"), F.col("_rg").alias("rg")).agg(F.max("label").alias("near"))
    return own.join(near, CELL, "left").select(*CELL, F.coalesce("label", "near", F.lit(0)).cast("long").alias("label"))


def eroded_labels(cells: DataFrame, erosion: int, block: int = BLOCK) -> DataFrame:
    """az, rg, label of a water mask's cells: features that only thin water joins are told apart.

    The mask is eroded and what is left labelled, in scan order. So many times, cells of the mask without a label then take the largest label in
    the 5 x 5 cells around. What is still without one (features that vanished) is grown by a step and labelled for itself: a part that
    touches labelled cells takes their most frequent label (the least on ties), also for the cells it touches; the others have labels of their own,
    after all others.
    """
    mask = written(cells.select(F.col("az").cast("long").alias("az"), F.col("rg").cast("long").alias("rg")).distinct(), "labels-mask")
    parts = written(components(eroded(mask, erosion), block), "labels-eroded")
    numbers = written(numbered(parts), "labels-numbers")
    labelled = written(parts.join(numbers, "part").select(*CELL, F.col("number").alias("label")), "labels-first")
    for _ in range(erosion):
        bare = mask.join(labelled, CELL, "left_anti").select(*CELL, F.col("az").alias("_az"), F.col("rg").alias("_rg"))
        taken = moved(bare, square(2)).join(labelled, CELL).groupBy(F.col("_az").alias("az"), F.col("_rg").alias("rg")).agg(F.max("label").alias("label"))
        labelled = written(labelled.unionByName(taken), "labels-grown")
    orphans = mask.join(labelled, CELL, "left_anti")
    grown = written(components(dilated(orphans, 1), block), "labels-orphans")
    met = grown.join(labelled, CELL).groupBy("part", "label").count()
    touched = met.groupBy("part").agg(F.min(F.struct((-F.col("count")).alias("n"), "label")).alias("b")).select("part", F.col("b.label").alias("own"))
    most = numbers.agg(F.coalesce(F.max("number"), F.lit(0)).alias("most"))
    given = numbered(grown).join(touched, "part", "left").join(F.broadcast(most), F.lit(True)).select("part", F.coalesce("own", F.col("number") + F.col("most")).alias("given"))
    by_orphan = grown.join(given, "part").select(*CELL, "given")
    return mask.join(labelled, CELL, "left").join(by_orphan, CELL, "left").select(*CELL, F.coalesce("given", "label").alias("label"))


#: Pixels that a node meets on average in the first ring, about.
MET = 64


def _first_cell(points: DataFrame, nodes: DataFrame, cell: float) -> float:
    """cell, halved until nodes meet some MET pixels in the nine cells around, as though pixels lay evenly within a cell. Counts of cells tell, not pairs."""
    held = points.groupBy(F.floor(F.col("nx") / cell).alias("cx"), F.floor(F.col("ny") / cell).alias("cy")).count()
    places = nodes.select("x", "y").distinct()
    met = places.select(rings.around("x", "y", cell).alias("_c")).select("_c.*").join(held, ["cx", "cy"]).agg(F.sum("count")).first()[0] or 0
    return cell / 2 ** max(0, math.ceil(math.log(max(met / (MET * places.count()), 1e-9), 4)))


def labels_of_reaches(pixels: DataFrame, nodes: DataFrame, cell: float, min_pixels: int = 3200, max_pixels: int | None = 100_000, seed: int = 1) -> DataFrame:
    """reach_id, label, distance: the label whose pixels lie nearest to each reach, by the mean over its nodes of the distance to the nearest pixel.

    pixels: x, y, label. nodes: reach_id, node_id, x, y. Labels of fewer than min_pixels pixels don't count; of larger ones than max_pixels so many are
    compared, the first by a seeded hash of the place; all without max_pixels. On ties (to 1e-9) the label of more pixels, then the lower one, counts. No reach meets
    all labels: the first ring is as small as the pixels around the nodes are dense (cell at most), and within rings of growing cells a node meets the pixels nearby, and a label it hasn't met yet lies farther than the ring. A reach is done when the mean
    of a label that all its nodes have met is below what every other label can still reach. Reaches without any label have no row.
    """
    pixels = pixels.where("label > 0 and x is not null and y is not null").select("label", "x", "y")
    sizes = pixels.groupBy("label").agg(F.count("*").alias("size"))
    sizes = written(sizes.where(F.col("size") >= min_pixels), "reach-labels-sizes")
    rows = pixels.join(sizes, "label")
    points = rows.select("label", "x", "y")
    if max_pixels is not None:
        # a label's first places by hash: the share of hashes that holds twice as many as wanted is ranked, not the whole label
        h = F.xxhash64(F.lit(seed), "x", "y")
        part = (F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53)).alias("h")
        large = rows.where(F.col("size") > max_pixels).select("label", "x", "y", part, "size")
        points = rows.where(F.col("size") <= max_pixels).select("label", "x", "y")
        if large.take(1):
            few = large.where(F.col("h") < 2.0 * max_pixels / F.col("size"))
            rank = F.row_number().over(Window.partitionBy("label").orderBy("h", "x", "y"))
            points = points.unionByName(few.withColumn("_k", rank).where(F.col("_k") <= max_pixels).select("label", "x", "y"))
    points = written(points.select("label", F.col("x").alias("nx"), F.col("y").alias("ny")).distinct(), "reach-labels-points")

    nodes = written(nodes.select("reach_id", "node_id", "x", "y"), "reach-labels-nodes")
    box = nodes.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    far = points.agg(F.min("nx"), F.max("nx"), F.min("ny"), F.max("ny")).first()
    if box[0] is None or far[0] is None:
        return nodes.select("reach_id", F.lit(None).cast(pixels.schema["label"].dataType).alias("label"), F.lit(0.0).alias("distance")).where("false")
    widest = float(np.hypot(max(box[1], far[1]) - min(box[0], far[0]), max(box[3], far[3]) - min(box[2], far[2]))) + 1.0
    counts = nodes.groupBy("reach_id").agg(F.count("*").alias("n"))
    undecided, done, cell = nodes, None, _first_cell(points, nodes, cell)
    while True:
        # few places, many pixels: places are dealt to nine cells, one that many nodes share is compared once
        places = undecided.where("x is not null and y is not null").select(F.col("x").alias("nx"), F.col("y").alias("ny")).distinct()
        met = rings.within_cell(points.withColumnsRenamed({"nx": "x", "ny": "y"}), places, cell)
        near = met.groupBy("nx", "ny", "label").agg(F.sqrt(F.min("d2")).alias("d")).withColumnsRenamed({"nx": "x", "ny": "y"}).join(undecided, ["x", "y"])
        sums = near.groupBy("reach_id", "label").agg(F.sum("d").alias("sum"), F.count("*").alias("k")).join(counts, "reach_id")
        bound = (F.col("sum") + (F.col("n") - F.col("k")) * cell) / F.col("n")
        sums = written(sums.select("reach_id", "label", bound.alias("bound"), (F.col("k") == F.col("n")).alias("whole")), "reach-labels-ring")
        best = sums.where("whole").join(sizes, "label").groupBy("reach_id").agg(F.min(F.struct(F.round("bound", 9).alias("_r"), (-F.col("size")).alias("m"), "label", "bound")).alias("b"))
        open_bound = sums.where("not whole").groupBy("reach_id").agg(F.min("bound").alias("open"))
        best = best.join(open_bound, "reach_id", "left").select("reach_id", "b.label", F.col("b.bound").alias("distance"), F.least(F.coalesce("open", F.lit(cell)), F.lit(cell)).alias("open"))
        last = cell >= widest
        found = written(best.where(F.lit(last) | (F.col("distance") + 1e-8 < F.col("open"))).select("reach_id", "label", "distance"), "reach-labels-done")
        done = found if done is None else done.unionByName(found)
        undecided = written(undecided.join(found, "reach_id", "left_anti"), "reach-labels-open")
        if last or not undecided.take(1):
            return done
        cell = min(2 * cell, widest)
