"""Joins by time and place against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluvion.operators import joins, spatial


def test_nearest_in_time_carries_borders_over_empty_stretches(spark):
    r = random.Random(4)
    readings = [(k, r.choice([r.uniform(0, 5e4), r.uniform(9e6, 9e6 + 50), 1e4]), i) for i, k in enumerate(r.choices([1, 2, 3], k=300))]
    instants = [(i, k, r.choice([r.uniform(-1e6, 1e7), 1e4, t + r.choice([-1000.0, 1000.0, 1000.5])])) for i, (k, t) in enumerate((r.choice([1, 2, 3, 4]), r.choice(readings)[1]) for _ in range(400))]
    instants += [(900, 1, None), (901, None, 5.0)]
    a = spark.createDataFrame(instants, "id long, k long, t double")
    b = spark.createDataFrame(readings + [(1, None, 999)], "k long, t double, reading long")
    for stretch, group in ((86400.0, 1024), (10.0, 4), (1e9, 2)):
        found = joins.nearest_on_axis(a, b, ["k"], "t", "t", "reading", stretch, earlier=True, group=group)
        got = {x.id: (x.reading, x.distance) for x in found.collect()}
        assert len(got) == len(instants)
        for i, k, t in instants:
            mine = [(abs(u - t), u, n) for q, u, n in readings if q == k and t is not None]
            if mine:
                d, _, n = min(mine)
                assert got[i] == (n, d), (stretch, i)
            else:
                assert got[i] == (None, None)
    ruled = {x.id: (x.gap, x.klass) for x in joins.nearest_in_time(a, b, ["k"], "t", "reading").collect()}
    assert all(klass == (1 if gap is not None and gap <= 1000 else 0) for gap, klass in ruled.values())
    assert {klass for _, klass in ruled.values()} == {0, 1}


def test_nearest_on_axis_without_a_key_and_of_empty_tables(spark):
    p = spark.createDataFrame([(1, 0.5), (2, 7.0)], "id long, x double")
    n = spark.createDataFrame([(3.0, 1), (-2.0, 2)], "at double, node long")
    assert {x.id: (x.node, x.distance) for x in joins.nearest_on_axis(p, n, [], "x", "at", "node", 1.0).collect()} == {1: (1, 2.5), 2: (1, 4.0)}
    assert joins.nearest_on_axis(p.where("false"), n, [], "x", "at", "node", 1.0).count() == 0
    assert [x.node for x in joins.nearest_on_axis(p, n.where("false"), [], "x", "at", "node", 1.0).collect()] == [None, None]


def test_nearest_on_axis_merges_crowded_stretches_in_parts(spark):
    p = spark.range(3000).select("id", (F.col("id") % 2).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 101 / 10).alias("x"))
    n = spark.createDataFrame([(0, float(a), a) for a in range(0, 10, 3)] + [(1, 4.0, 4)], "k long, at double, node long")
    rows = lambda d: sorted(tuple(x) for x in d.select("id", "_at", "_lo", "_hi").collect())
    whole, parts = (joins.bracketed(p, n, ["k"], "x", "at", "node", 4.0, chunk=c) for c in (10_000, 50))
    assert rows(parts) == rows(whole)
    held = joins._in_chunks(p.withColumn("_stretch", F.floor(F.col("x") / 4)), n.withColumn("_stretch", F.floor(F.col("at") / 4)), ["k", "_stretch"], p.columns, 50)[0]
    assert max(r["count"] for r in held.groupBy("k", "_stretch", "_part").count().collect()) < 100


def brute_boxes(left, right):
    """Overlaps by fine points along each axis' arcs: arcs overlap if either begins inside the other."""
    out = []
    for i, ax, ay, aw, ah in left:
        for j, bx, by, bw, bh in right:
            east, west = (bx - ax) % 360, (ax - bx) % 360
            if (east < aw or west < bw) and ay < by + bh and by < ay + ah:
                out.append((i, j))
    return sorted(out)


@pytest.mark.parametrize("cell", [1.0, 7.5, 45.0, 360.0])
def test_box_overlaps_equal_brute_force(spark, cell):
    r = random.Random(8)
    made = [[(i, r.choice([-180, 178.5, 170, r.uniform(-180, 180)]), r.uniform(-80, 70), r.choice([0.25, 3, 20, 100]), r.choice([0.25, 2, 9])) for i in range(60)] for _ in range(2)]
    frame = lambda rows, name: spark.createDataFrame([(i, float(x), y, float(x + w), float(y + h)) for i, x, y, w, h in rows], f"{name} long, x0 double, y0 double, x1 double, y1 double")
    a, b = frame(made[0], "a"), frame(made[1], "b")
    # the same boxes told in another turn, or with an east edge beyond the antimeridian wrapped
    b = b.withColumn("x1", F.when(F.col("x1") > 180, F.col("x1") - 360).otherwise(F.col("x1"))).withColumn("x0", F.col("x0") + 360).withColumn("x1", F.col("x1") + 360)
    got = sorted((x.a, x.b) for x in spatial.box_overlaps(a, b, cell).collect())
    assert got == brute_boxes(*made) and len(got) > 20


def test_box_overlaps_of_odd_boxes(spark):
    s = "k long, x0 double, y0 double, x1 double, y1 double"
    a = spark.createDataFrame([(1, -180.0, -90.0, 180.0, 90.0), (2, None, 0.0, 1.0, 1.0), (3, 0.0, 5.0, 1.0, 1.0), (4, 10.0, 0.0, 11.0, 1.0), (4, 10.0, 0.0, 11.0, 1.0)], s)
    b = spark.createDataFrame([(7, 11.0, 0.0, 12.0, 1.0), (8, 10.5, 0.5, 10.6, 0.6)], s).withColumnRenamed("k", "o")
    assert sorted((x.k, x.o) for x in spatial.box_overlaps(a, b, 10.0).collect()) == [(1, 7), (1, 8), (4, 8), (4, 8)]
    assert spatial.box_overlaps(a.where("false"), b, 10.0).count() == 0
    with pytest.raises(ValueError, match="multiple"):
        spatial.box_overlaps(a, b, 7.0)


def brute_sample(v, fi, fj, order):
    n, m = v.shape
    if not (0 <= fi <= n - 1 and 0 <= fj <= m - 1):
        return 0.0
    mirror = lambda k, n: abs(k) if abs(k) <= n - 1 else 2 * (n - 1) - abs(k)

    def taps(f):
        b = int(np.floor(f))
        t = f - b
        if order == 0:
            return [(b if t < 0.5 else b + 1, 1.0)]
        if order == 1:
            return [(b, 1 - t), (b + 1, t)]
        return [(b - 1, (1 - t) ** 3 / 6), (b, 2 / 3 - t * t * (2 - t) / 2), (b + 1, 2 / 3 - (1 - t) ** 2 * (1 + t) / 2), (b + 2, t**3 / 6)]

    return sum(wa * wb * v[mirror(a, n), mirror(b, m)] for a, wa in taps(fi) for b, wb in taps(fj) if wa * wb)


@pytest.mark.parametrize("order", [0, 1, 3])
def test_samples_equal_brute_force(spark, order):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(23, 37))
    cells = spark.createDataFrame([(i, j, float(v[i, j])) for i in range(23) for j in range(37)], "i long, j long, v double")
    places = [(float(a), float(b)) for a, b in zip(rng.uniform(-2, 25, 400), rng.uniform(-2, 39, 400), strict=True)] + [(0.0, 0.0), (22.0, 36.0), (7.0, 8.0), (7.5, 8.5), (22.0001, 3.0), (15.999, 15.999)]
    p = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(places)], "id long, fi double, fj double")
    for tile in (4, 16):
        got = {x.id: x.value for x in spatial.sample_raster(p, cells, (23, 37), order=order, tile=tile).collect()}
        assert all(got[k] == pytest.approx(brute_sample(v, a, b, order), abs=1e-12) for k, (a, b) in enumerate(places))


def test_samples_of_missing_cells_and_places(spark):
    cells = spark.createDataFrame([(0, 0, 1.0), (0, 1, None), (2, 0, 5.0)], "i long, j long, v double")
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.5), (3, 1.5, 0.0), (4, None, 0.0), (5, 2.0, 0.0), (6, 9.0, 0.0)], "id long, fi double, fj double")
    assert {x.id: x.value for x in spatial.sample_raster(p, cells, (3, 2)).collect()} == {1: 1.0, 2: None, 3: None, 4: None, 5: 5.0, 6: 0.0}
    assert {x.value for x in spatial.sample_raster(p, cells.where("false"), (3, 2), outside=-9.0).collect()} == {None, -9.0}


def test_splines_mirror_at_all_edges_of_small_rasters(spark):
    rng = np.random.default_rng(3)
    for n, m in ((2, 3), (3, 2), (5, 16), (17, 4)):
        v = rng.normal(size=(n, m))
        cells = spark.createDataFrame([(i, j, float(v[i, j])) for i in range(n) for j in range(m)], "i long, j long, v double")
        places = [(a * (n - 1) / 6, b * (m - 1) / 6) for a in range(7) for b in range(7)]
        p = spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in enumerate(places)], "id long, fi double, fj double")
        got = {x.id: x.value for x in spatial.sample_raster(p, cells, (n, m), order=3, tile=4).collect()}
        assert all(got[k] == pytest.approx(brute_sample(v, a, b, 3), abs=1e-12) for k, (a, b) in enumerate(places))


def test_code_of_splines_is_small_enough_to_be_compiled(spark):
    import re

    p = spark.range(5).select("id", (F.col("id") / 3).alias("fi"), (F.col("id") / 4).alias("fj"))
    cells = spark.range(30).select(F.floor(F.col("id") / 6).alias("i"), (F.col("id") % 6).alias("j"), F.col("id").cast("double").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = spatial.sample_raster(p, cells, (5, 6), order=3)._jdf.queryExecution()
        text = plan.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)) < 8000
