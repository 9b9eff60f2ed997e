"""Closed-form truths: centerline goldens, the synthetic river, kernels."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fluvion.functions import geo
from fluvion.operators import discharge, fits, joins, labels
from fluvion.plans import river_tile
from fluvion.sources import config, field, products, synthetic
from fluvion.streaming import gauges


def test_straight_centerline(spark):
    t = 2**-0.5
    v = spark.createDataFrame([(i, i / 10, i / 10, t, t) for i in range(10)], "vertex_id long, x double, y double, tx double, ty double")
    p = spark.createDataFrame([(1, 0.1, 100.0)], "point_id long, x double, y double")
    row = joins.nearest_vertex(p, v, cell=200.0).first()
    assert row.vertex_id == 9
    assert (row.d, row.s, row.n) == pytest.approx((99.10322901, 69.50859659, 70.63996744), abs=1e-3)


def test_river_has_its_slope_and_outlier(spark):
    assigned = river_tile.assign(synthetic.pixels(spark), synthetic.vertices(spark), synthetic.SPACING)
    nodes = river_tile.nodes(assigned)
    per_node = nodes.where("node_id between 1 and 18").toPandas()
    assert (per_node.n_pix == 70).all()
    assert per_node.area.between(1, 70 * 400).all()
    out = {r.reach_id: r for r in river_tile.reaches(nodes, synthetic.prior_nodes(spark)).collect()}
    assert sorted(out) == [11, 21, 31, 41]
    for reach in (11, 21, 31):
        assert out[reach].slope == pytest.approx(synthetic.SLOPE, abs=1e-9)
    assert out[11].n_good_nod == 19 and out[21].n_good_nod == 20
    assert out[41].slope is None and out[41].reach_q == 3 and out[41].obs_frac == 0


def test_wide_rivers_keep_their_pixels_wherever_cells_begin(spark):
    offsets = [(-550.0, 0.0), (-550.0, 250.0), (0.0, 299.0), (100.0, -299.0), (-650.0, 0.0), (0.0, 301.0), (100.0, -301.0)]
    for origin in (0.0, 130.0, 333.0, 520.0):
        v = synthetic.vertices(spark, 1).withColumn("x", F.col("x") + origin)
        p = spark.createDataFrame([(i, origin + x, y) for i, (x, y) in enumerate(offsets)], "point_id long, x double, y double")
        kept = {r.point_id for r in river_tile.assign(p, v, synthetic.SPACING).collect()}
        assert kept == {0, 1, 2, 3}


def test_spline_reproduces_cubic():
    s = np.linspace(0, 3, 7)
    v, d = fits.cubic(s, s**3 - s, np.array([0.1, 1.7, 2.9]))
    assert v == pytest.approx([0.1**3 - 0.1, 1.7**3 - 1.7, 2.9**3 - 2.9]) and d == pytest.approx([3 * 0.01 - 1, 3 * 1.7**2 - 1, 3 * 2.9**2 - 1])
    line = fits.spline_resample(np.array([0.0, 0, 1, 2, 3]), np.zeros(5), 0.5)
    assert line.s.tolist() == [0.25, 0.75, 1.25, 1.75, 2.25, 2.75] and line.tx.tolist() == pytest.approx([1] * 6)


def test_bayes_and_enhanced_slope_of_a_line(spark):
    n = spark.range(60).select(F.lit(1).cast("long").alias("reach_id"), (F.col("id") * 200.0).alias("s"), (10 + F.col("id") * 0.02).alias("wse"), F.lit(0.1).alias("wse_u"))
    assert fits.bayes_slope(n).first().slope == pytest.approx(1e-4, rel=1e-6)
    assert fits.enhanced_slope(n).first().slope == pytest.approx(1e-4, rel=1e-6)


def test_outlier_masks(spark):
    rows = [(1, i, 200.0 * i, 10 + 0.02 * i + (60 if i == 4 else 0), 0.1) for i in range(20)]
    n = spark.createDataFrame(rows, "reach_id long, node_id long, s double, wse double, wse_u double")
    for f in (fits.linear_outliers, fits.piecewise_outliers):
        assert [r.node_id for r in f(n).where("not good").collect()] == [4]


def test_components_follow_scan_order(spark):
    grid = ["110", "001", "101"]
    p = spark.createDataFrame([(a, r) for a, row in enumerate(grid) for r, v in enumerate(row) if v == "1"], "az long, rg long")
    parts = labels.components(p)
    got = {(r.az, r.rg): r.number for r in parts.join(labels.numbered(parts), "part").collect()}
    assert got == {(0, 0): 1, (0, 1): 1, (1, 2): 2, (2, 2): 2, (2, 0): 3}


def test_nearest_on_axis_ties_and_missing(spark):
    p = spark.createDataFrame([(1, 1, 5.0), (2, 1, -3.0), (3, 2, 1.0), (4, 1, 99.0)], "id long, k long, h double")
    n = spark.createDataFrame([(1, 4.0, 10), (1, 6.0, 11)], "k long, at double, node long")
    got = {r.id: (r.node, r.distance) for r in joins.nearest_on_axis(p, n, ["k"], "h", "at", "node", 2.0).collect()}
    assert got == {1: (10, 1.0), 2: (10, 7.0), 3: (None, None), 4: (11, 93.0)}


@pytest.mark.parametrize("sizes", [{}, {"block": 3}, {"block": 3, "work": 40, "chunk": 5}, {"block": 1, "work": 1, "chunk": 1}])
def test_overlapping_equals_brute_force(spark, sizes):
    """Sparse and crowded buckets, touching ends, ends before starts, nulls and keys of one side."""
    rng = np.random.default_rng(11)
    one = [(i, int(rng.integers(0, 4)), float(a), float(a + w)) for i, (a, w) in enumerate(zip(rng.integers(-40, 40, 60) / 4, rng.integers(-3, 20, 60) / 4))]
    two = [(i, int(rng.integers(1, 5)), float(x), float(x + w)) for i, (x, w) in enumerate(zip(rng.exponential(6, 90).round(1), rng.integers(-2, 12, 90) / 4))]
    one += [(100, None, 0.0, 1.0), (101, 1, None, 1.0), (102, 1, 0.0, None)]
    two += [(100, None, 0.0, 1.0), (101, 1, None, 1.0), (102, 1, 0.0, None)]
    full = lambda row: None not in row
    want = sorted((i, j) for i, k, a, b in filter(full, one) for j, m, x, y in filter(full, two) if k == m and a <= y and x <= b)
    left, right = spark.createDataFrame(one, "i long, k int, a double, b double"), spark.createDataFrame(two, "j long, k int, x double, y double")
    met = joins.overlapping(left, right, "a", "b", "x", "y", 2.0, ["k"], **sizes)
    assert met.columns == ["k", "i", "a", "b", "j", "x", "y"]
    assert sorted((r.i, r.j) for r in met.collect()) == want
    assert joins.overlapping(left.where("k = 9"), right, "a", "b", "x", "y", 2.0, ["k"], **sizes).count() == 0


def test_overlapping_joins_rows_with_blocks(spark):
    """the join itself yields a row for each block met, not for each pair."""
    left, right = spark.range(200).selectExpr("id as i", "1.0D as a", "2.0D as b"), spark.range(300).selectExpr("id as j", "1.5D as x", "1.75D as y")
    met = joins.overlapping(left, right, "a", "b", "x", "y", 5.0)
    assert len(met.collect()) == 60_000

    def joined(plan) -> int:
        rows = plan.metrics().get("numOutputRows")
        own = rows.get().value() if "Join" in plan.nodeName() and rows.isDefined() else 0
        inner = [plan.children().apply(i) for i in range(plan.children().size())] + ([plan.plan()] if "QueryStage" in plan.nodeName() else []) + ([plan.executedPlan()] if plan.nodeName() == "AdaptiveSparkPlan" else [])
        return max([own, *map(joined, inner)])

    assert 200 <= joined(met._jdf.queryExecution().executedPlan()) <= 400


def test_overlapping_tells_the_rows_of_a_block_again_and_again(spark, tmp_path):
    """files of pairs hold runs that repeat: 8 million pairs took 32 MB when each row of left met all blocks in turn."""
    left, right = spark.range(200).selectExpr("id as i", "1.0D as a", "2.0D as b"), spark.range(40_000).selectExpr("id as j", "1.5D as x", "1.75D as y")
    joins.overlapping(left, right, "a", "b", "x", "y", 5.0).select("i", "j").write.parquet(str(tmp_path / "pairs"))
    assert spark.read.parquet(str(tmp_path / "pairs")).count() == 8_000_000
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 4_000_000


def test_laea_centre_and_wrap(spark):
    x, y = geo.laea(F.lit(-75.0), F.lit(40.0), F.lit(-75.0), F.lit(40.0))
    row = spark.range(1).select(x.alias("x"), y.alias("y"), geo.wrap(F.lit(190.0)).alias("w"), geo.wrap(F.lit(-180.0)).alias("v")).first()
    assert (row.x, row.y) == pytest.approx((0, 0), abs=1e-6) and row.w == -170 and row.v == -180


def test_consensus_skips_nulls(spark):
    m = [F.lit(3.0), F.lit(None).cast("double"), F.lit(1.0), F.lit(10.0)]
    assert spark.range(1).select(discharge.consensus(*m)).first()[0] == 3.0
    assert spark.range(1).select(discharge.consensus(F.lit(None).cast("double"))).first()[0] is None


def test_config_and_product_round_trip(spark, tmp_path):
    got = config.parse("a (m) = 1 2 ! note\nLong Key = x \\\n y\neof\nb = 2\n")
    assert got == {"a": ("1 2", "m"), "long key": ("x   y", None)} and config.numbers(got["a"][0]) == [1.0, 2.0]
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType

    schema = StructType([StructField("id", LongType()), StructField("v", DoubleType(), True, {"fill": -9999.0}), StructField("w", DoubleType())])
    products.write(spark.createDataFrame([(1, float("nan"), 1.0), (2, 2.0, None)], "id long, v double, w double"), str(tmp_path / "p"), schema)
    back = products.read(spark, str(tmp_path / "p"), StructType([*schema, StructField("extra", LongType())])).toPandas().sort_values("id")
    assert back.v.tolist() == [-9999.0, 2.0] and back.extra.isna().all()


def test_gauges_batch_and_stream_agree(spark, tmp_path):
    rows = [((pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=3 * i)).to_pydatetime(), i % 2, float(i)) for i in range(40)]
    spark.createDataFrame(rows, "t timestamp, k long, v double").write.parquet(str(tmp_path / "in"))
    batch = gauges.windowed(spark.read.parquet(str(tmp_path / "in")), "t", "k", "v").orderBy("k", "start").collect()
    stream = gauges.windowed(spark.readStream.schema("t timestamp, k long, v double").parquet(str(tmp_path / "in")), "t", "k", "v")
    q = stream.writeStream.format("memory").queryName("gauges").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    q.awaitTermination()
    assert spark.table("gauges").orderBy("k", "start").collect() == batch


def test_utm_inverse(spark):
    lon, lat = geo.utm_inverse(F.col("e"), F.col("n"), 10)
    row = spark.createDataFrame([(500000.0, 0.0), (500000.0, 4427757.218739)], "e double, n double").select(lon.alias("lon"), lat.alias("lat")).collect()
    assert (row[0].lon, row[0].lat) == pytest.approx((-123, 0)) and (row[1].lon, row[1].lat) == pytest.approx((-123, 40), abs=1e-7)


def test_transducer_text(spark, tmp_path):
    lines = ["a b c P1 P2", "Northing m 4427757.218739 0", "Easting m 500000 500000", "River mile 3.5 4", "", "YYYYMMDD HHMMSS P1 P2", "20000101\t000010\t1.5\t ", "20000102\t000000\t2.5\t3"]
    (tmp_path / "pt.txt").write_text("\n".join(lines) + "\n")
    got = {(r.transducer, r.time): r for r in field.transducers(spark, str(tmp_path / "pt.txt")).collect()}
    assert {k: r.wse for k, r in got.items()} == {("P1", 10.0): 1.5, ("P2", 10.0): None, ("P1", 86400.0): 2.5, ("P2", 86400.0): 3.0}
    assert got["P1", 10.0].latitude == pytest.approx(40, abs=1e-7) and got["P1", 10.0].river_mile == 3.5


def test_drifter_text_and_grid(spark, tmp_path):
    (tmp_path / "d.txt").write_text(" 1.0  2 0.1\n\n3 x 0.5\n")
    rows = field.drifter_pixels(field.drifters(spark, str(tmp_path / "d.txt"), ["time", "wse", "err"]), "err").orderBy("time").collect()
    assert [(r.time, r.wse, r.classification) for r in rows] == [(1.0, 2.0, 1), (3.0, None, 0)]
    header = field.grid_header("undef -9999\noptions yrev little_endian\nxdef 3 linear -125.0 0.5\nydef 2 linear 35.0 0.5\n")
    np.array([[1, -9999, 3], [4, 5, -9999]], "<f4").tofile(tmp_path / "g.bin")
    cells = {(r.longitude, r.latitude): r.value for r in field.grid(spark, str(tmp_path / "g.bin"), header).collect()}
    assert cells == {(-125.0, 35.5): 1.0, (-124.0, 35.5): 3.0, (-125.0, 35.0): 4.0, (-124.5, 35.0): 5.0}


def test_broken_lines_of_many_reaches_together_and_alone():
    rng = np.random.default_rng(6)
    reaches = []
    for n in (3, 11, 20, 21, 34, 50, 50):
        s = np.sort(rng.choice(200, n, replace=False)) * 100.0
        y = 20 + 0.002 * s + np.maximum(s - 9000, 0) * 0.01 + rng.normal(0, 4, n) + 80 * (rng.random(n) < 0.1)
        reaches.append((s, y, np.ones(n), rng.integers(0, 4, n).astype(float), 10.0))
    together = fits.piecewise_good(reaches, 80.0, 0.1, 0.1, 10, 30)
    assert [len(g) for g in together] == [len(r[0]) for r in reaches]
    for reach, good in zip(reaches, together, strict=True):
        assert fits.piecewise_good([reach], 80.0, 0.1, 0.1, 10, 30)[0].tolist() == good.tolist()
    s = np.arange(40) * 200.0  # the line that is told, with its break, and one node off it
    y = 10 + 0.001 * s + np.maximum(s - 4100, 0) * 0.05
    y[7] += 100
    assert np.flatnonzero(~fits.piecewise_good([(s, y, np.ones(40), np.zeros(40), 10.0)], 80.0, 0.1, 0.1, 10, 30)[0]).tolist() == [7]
