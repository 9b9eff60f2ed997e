"""Percentiles by counting, scenes, discharge and filters against independent versions."""

import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluvion.operators import assign, completion, discharge, metrics, quantiles
from fluvion.plans import catalogue, published
from fluvion.plans.catalogue import SQL
from fluvion.sources import scenes


def test_percentiles_by_counting_equal_sorting(spark):
    rng = np.random.default_rng(0)
    groups = {1: rng.normal(size=500), 2: np.concatenate([np.full(300, 7.0), rng.normal(size=50) * 1e9]), 3: np.array([4.25]), 4: np.array([1e-300, 1e300, -1e300, 0.0]), None: rng.integers(0, 5, 200).astype(float)}
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [(1, None), (1, float("nan")), (9, None)]
    df = spark.createDataFrame(rows, "bin long, v double").repartition(5)
    shares = {"n16": 0.16, "p50": 0.5, "p68": 0.68, "p100": 1.0, "p0": 0.0}
    got = {r["bin"]: r for r in quantiles.percentiles(df, ["bin"], "v", shares).collect()}
    assert set(got) == set(groups)
    for k, x in groups.items():
        assert got[k].n == len(x)
        for name, share in shares.items():
            assert got[k][name] == pytest.approx(np.quantile(x, share), rel=1e-12, abs=1e-300)
    whole = quantiles.percentiles(df.where("bin = 1"), [], "v", {"p50": 0.5}).first()
    assert whole.p50 == pytest.approx(np.median(groups[1]))
    assert quantiles.percentiles(df.where("false"), ["bin"], "v", shares).count() == 0


def test_scenes_are_pruned_by_their_names(spark, tmp_path):
    for name in ("w083n38", "w084n38", "e179s01", "w180s01", "w010n10", "readme"):
        spark.createDataFrame([(name, 1)], "tile string, v long").coalesce(1).write.parquet(f"{tmp_path}/{name}_cycle_1.parquet")
    files = scenes.files_of(spark, str(tmp_path)).where("name like '%.parquet'").withColumn("name", F.regexp_extract("path", "/([^/]+)_cycle", 1))
    catalogue = scenes.coverage(files)
    rows = {r.name: r for r in catalogue.collect()}
    assert (rows["w083n38"].x0, rows["w083n38"].y0, rows["w083n38"].x1, rows["w083n38"].y1) == (-83, 38, -82, 39) and rows["e179s01"].y0 == -1
    assert rows["w083n38"].polygon == "POLYGON ((-82.000000 38.000000, -82.000000 39.000000, -83.000000 39.000000, -83.000000 38.000000, -82.000000 38.000000))" and rows["readme"].polygon is None
    found = scenes.read_overlapping(spark, catalogue, (-83.5, 38.2, -82.9, 38.4))
    assert sorted(r.tile for r in found.collect()) == ["w083n38", "w084n38"] and len(found.inputFiles()) == 2
    assert sorted(r.tile for r in scenes.read_overlapping(spark, catalogue, (179.5, -0.9, -179.5, -0.1)).collect()) == ["e179s01", "w180s01"]
    assert scenes.read_overlapping(spark, catalogue, (50.0, 50.0, 51.0, 51.0)) is None


def test_unequal_scenes_are_merged_padded_and_put_aside(spark):
    a = spark.createDataFrame([(1, [1, 2], 0.5), (1, [3], None)], "scene long, codes array<int>, x double")
    b = spark.createDataFrame([(2, [4, 5, 6], "t"), (3, None, "u"), (None, [], "v")], "scene long, codes array<int>, y string")
    rows = scenes.padded(scenes.merged([a, b])).collect()
    assert sorted((r.scene or 0, [c or 0 for c in r.codes], r.x, r.y) for r in rows if r.scene != 1) == [(0, [0, 0, 0], None, "v"), (2, [4, 5, 6], None, "t"), (3, [0, 0, 0], None, "u")]
    assert sorted(r.codes[0] for r in rows if r.scene == 1) == [1, 3] and all(len(r.codes) == 3 for r in rows)
    good, bad = scenes.put_aside(scenes.merged([a, b]), "scene", {"no codes": F.max(F.size("codes")) < 1, "one row": F.count("*") < 2, "no x": F.count("x") == 0})
    assert [r.scene for r in good.collect()] == [1, 1]
    assert {(r.scene, r.reason, r.n) for r in bad.collect()} == {(2, "one row", 1), (3, "one row", 1), (None, "no codes", 1)}


def brute_section(h, w, spread, breaks, lines, median, wv, hv):
    """Fitted height and change of section, in plain floats."""
    inside = [k for k in range(len(lines)) if breaks[k] <= h < breaks[k + 1]]
    poly = lambda k, x: lines[k][0] / 2 * x * x + lines[k][1] * x
    if not inside:
        if h >= breaks[-1]:
            return None, poly(len(lines) - 1, breaks[-1]) - poly(len(lines) - 1, breaks[-2]) + median
        return None, -median - (breaks[0] - h) * (w + lines[0][0] * breaks[0] + lines[0][1]) / 2
    k = inside[0]

    def fitted(k):
        m, b = lines[k]
        return h - (w - b - m * h) * (-m * hv) / (wv + m * m * hv)

    hat = h if (spread - hv) / hv < 2 else fitted(k)
    moved = [j for j in range(len(lines)) if breaks[j] <= hat < breaks[j + 1]]
    if moved:
        k = moved[0]
        hat = fitted(k)
    return hat, sum(poly(j, min(hat, breaks[j + 1])) - poly(j, breaks[j]) for j in range(k + 1)) - median


def test_sections_equal_the_plain_rule(spark):
    rng = np.random.default_rng(3)
    breaks, lines = [32.0, 34.0, 36.0, 38.0], [(2.0, 10.0), (4.0, -58.0), (0.0, 86.0)]
    rows = [(i, float(h), float(w), float(s)) for i, (h, w, s) in enumerate(zip(rng.uniform(30, 40, 200), rng.uniform(60, 100, 200), rng.choice([0.3, 5.0], 200), strict=True))] + [(900, 38.0, 80.0, 5.0), (901, 32.0, 80.0, 5.0)]
    df = spark.createDataFrame(rows, "id long, h double, w double, s double")
    got = {r.id: r for r in discharge.section_change(df, F.col("h"), F.lit(0.5), F.col("w"), F.lit(3.0), [F.lit(b) for b in breaks], [(F.lit(a), F.lit(b)) for a, b in lines], F.lit(150.0), F.lit(9.0), F.lit(0.25), F.col("s")).collect()}
    for i, h, w, s in rows:
        hat, area = brute_section(h, w, s, breaks, lines, 150.0, 9.0, 0.25)
        assert got[i].d_area == pytest.approx(area) and (got[i].fit_height is None if hat is None else got[i].fit_height == pytest.approx(hat))
        assert got[i].d_area_u is not None and got[i].d_area_u >= 0


def test_flag_and_consensus(spark):
    names = ("metroman", "bam", "hivdi", "momma", "sads", "sic4dvar")
    none, one = F.lit(None).cast("double"), F.lit(2.0)
    base = {k: F.lit(10.0) for k in names if k != "momma"}
    f = lambda **k: spark.range(1).select(discharge.flag(**({"reach_q": F.lit(0), "slope": F.lit(1e-4), "slope_u": F.lit(1e-6), "d_area": F.lit(0.0), "bases": base, "bed": F.lit(1.0), "bankfull": F.lit(2.0), "models": dict.fromkeys(names, one)} | k))).first()[0]
    assert f() == 0
    assert f(reach_q=F.lit(3), slope=F.lit(-1e-4), slope_u=F.lit(1e-3), d_area=F.lit(-11.0), bed=F.lit(3.0), models=dict.fromkeys(names, none)) == sum(1 << k for k in (22, 24, 3, 4, 5, 6, 7, 8, 23))
    assert f(reach_q=F.lit(1), slope_u=F.lit(1e-4), models=dict.fromkeys(names, one) | {"bam": none}) == (1 << 0) + (1 << 1) + (1 << 11)
    assert f(reach_q=F.lit(2), slope=F.lit(0.0)) == 1 << 18
    parts = discharge.consensus_parts([F.lit(1.0), F.lit(5.0), none], [F.lit(0.3), F.lit(0.5), none], [F.lit(0.2), F.lit(0.4), none])
    row = spark.range(1).select(*(v.alias(k) for k, v in parts.items())).first()
    s = math.sqrt(math.pi / 2 * 0.4**2 / 2)
    assert (row.q, row.q_s_u, row.q_u) == pytest.approx((3.0, s, math.hypot(s, 0.3))) and row.q_s_rel == pytest.approx(s / math.hypot(s, 0.3))


def test_neighbour_filter_cuts_beyond_the_nearest_gaps(spark):
    # part, ss, node_q, good
    rows = [(-1, 0, 0, True), (-1, 1500, 0, True), (-1, 2000, 3, True), (-1, 2400, 0, True), (0, 3000, 3, True), (0, 5000, 0, True), (0, 5200, 0, False), (1, 5600, 0, True), (1, 5800, 0, True), (1, 7000, 0, True)]
    df = spark.createDataFrame([(1, k, p, float(s), q, g) for k, (p, s, q, g) in enumerate(rows)], "reach_id long, node_id long, part int, ss double, node_q int, good boolean")
    got = [r.good for r in assign.neighbour_filter(df).orderBy("node_id").collect()]
    # the downstream gap begins at 0; 2000 is bad; the gap inside the reach cuts nothing; the upstream gap begins at 5800, which goes as well
    assert got == [False, True, False, True, True, True, False, True, False, False]


def test_science_of_nulls_is_outside(spark):
    names = ["xtrk", "width", "area", "length", "truth_obs_frac", "dark_frac", "flag", "xtrk_ratio", "obs_frac", "data_dark_frac"]
    rows = [(20_000.0, 200.0, 9e5, 9000.0, 1.0, 0.1, 5, 0.9, 0.9, 0.2), (20_000.0, None, 9e5, 9000.0, 1.0, 0.1, 5, 0.9, 0.9, 0.2), (5000.0, 50.0, 1.0, 1.0, 0.5, 0.1, 33_554_433, 0.1, 0.1, 1.0)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'long' if n == 'flag' else 'double'}" for n in names))
    assert [r.in_science for r in metrics.science(df).collect()] == [True, False, False]
    assert tuple(metrics.outside_counts(df).first()) == (3, 1, 1, 1, 1, 1, 1, 1, 1)


def test_products_cover_the_prior_database(spark):
    prior = spark.createDataFrame([(11, 1, 0.0, 0.0), (11, 2, 200.0, 0.0), (26, 1, 0.0, 0.0), (26, 2, 0.0, 9.0), (31, 1, 0.0, 0.0)], "reach_id long, node_id long, x_prior double, y_prior double")
    seen = spark.createDataFrame([(11, 1, 3.0, 4.0, 12, 1, 1024, 0, None), (99, 1, 1.0, 1.0, 5, 0, 0, 0, 2.0)], "reach_id long, node_id long, x double, y double, n_good_pix long, node_q int, node_q_b long, xovr_cal_q int, wse double")
    rows = {(r.reach_id, r.node_id): r for r in completion.complete_nodes(prior, seen).collect()}
    assert sorted(rows) == [(11, 1), (11, 2)]  # ghosts, reaches of one node and unknown ones aren't there
    one, two = rows[11, 1], rows[11, 2]
    assert (one.node_dist, one.node_q, one.node_q_b, one.wse, one.n_good_pix) == (5.0, 1, 1024, completion.FILL_FLOAT, 12)
    assert (two.node_q, two.node_q_b, two.xovr_cal_q, two.n_good_pix, two.wse, two.node_dist) == (3, sum(1 << k for k in (24, 25, 26, 27, 28)), 2, completion.FILL_LONG, completion.FILL_FLOAT, completion.FILL_FLOAT)
    reaches = spark.createDataFrame([(11, [21, 0], [0]), (26, [], []), (31, [], []), (41, [0], [11, 0])], "reach_id long, up array<long>, down array<long>")
    nodes = prior.union(spark.createDataFrame([(41, 1, 0.0, 0.0), (41, 2, 0.0, 0.0)], prior.schema))
    got = spark.createDataFrame([(11, 0.6, 1, 5, 0)], "reach_id long, obs_frac_n double, reach_q int, reach_q_b long, dschg_q_b long")
    rows = {r.reach_id: r for r in completion.complete_reaches(reaches, got, nodes).collect()}
    assert sorted(rows) == [11, 41]
    assert (rows[11].n_up, rows[11].up, rows[11].down, rows[11].partial_f, rows[11].reach_q) == (1, [21, completion.FILL_LONG], [completion.FILL_LONG], 0, 1)
    assert (rows[41].reach_q, rows[41].reach_q_b, rows[41].dschg_q_b, rows[41].partial_f, rows[41].n_down) == (3, (1 << 26) + (1 << 27) + (1 << 28), (1 << 22) + (1 << 23), 1, 1)


def test_field_checks_name_what_is_broken(spark):
    rows = spark.createDataFrame([(1.0, 4, None), (float("nan"), 8, 1.0), (float("inf"), 3, 2.0), (-9999.0, 0, None), (-5.0, 16, 3.0)], "v double, flags long, maybe double")
    fields = {"v": {"valid_min": 0.0, "valid_max": 10.0, "fill": -9999.0}, "flags": {"flag_masks": [1, 2, 4]}, "maybe": {"nullable": True, "valid_max": 2.5}}
    got = {(r.field, r.problem): r.n for r in completion.check_fields(rows, fields).collect()}
    assert got == {("v", "missing"): 1, ("v", "infinite"): 1, ("v", "low"): 1, ("v", "high"): 1, ("flags", "bits"): 2, ("maybe", "high"): 1}
    assert completion.check_fields(rows.where("false"), fields).count() == 0


def test_passes_are_unions_in_order(spark):
    a, b = spark.createDataFrame([(5, 1.0)], "reach_id long, wse double"), spark.createDataFrame([(3, 7)], "reach_id long, extra long")
    assert [(r.reach_id, r.wse, r.extra) for r in completion.pass_product([a, b], ["reach_id"]).collect()] == [(3, None, 7), (5, 1.0, None)]
    assert completion.every(spark.range(10).withColumnRenamed("id", "az"), 3, "az").count() == 4


def _bases(spark, path, **rows):
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def _lineitem(spark, path, rows, **others):
    """Rows of order, part, supplier, line, quantity, price, returnflag."""
    values = [(*x[:6], 0.02, 0.04, x[6], "F") for x in rows]
    return _bases(spark, path, lineitem=(values, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"), **others)


def _sql(path, sql):
    import duckdb

    con = duckdb.connect()
    for p in Path(path).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}/*.parquet'")
    return sorted(con.execute(sql).fetchall())


def test_models_of_an_empty_section_are_zero(spark, tmp_path):
    one = F.lit(1.0)
    got = spark.range(1).select(discharge.hivdi(one, one, F.lit(-800.0), F.lit(800.0), F.lit(30.0), F.lit(0.05)).alias("hivdi"), discharge.momma(one, one, F.col("id") + 35.5, F.lit(35.5), F.lit(38.0), one).alias("momma")).first()
    assert got.hivdi == 0 and got.momma is None
    # 49 nodes of 300 each: the section of 14,700 - 15,500 + 800 is empty
    rows = [(k, k, 7, 4, 300.0, 40000.0, "N") for k in range(49)]
    path = _lineitem(spark, tmp_path, rows)
    assert [tuple(x) for x in published.discharge_flag(spark, path).collect()] == _sql(path, SQL["discharge_flag"])


def test_nodes_without_good_pixels_have_no_area_deviation(spark, tmp_path):
    rows = [(k, k % 2, 3, 1 + k % 7, 10.0 + k, 1000.0 * k, "A" if k % 2 else "N") for k in range(12)]
    path = _lineitem(spark, tmp_path, rows)
    got = sorted(tuple(x) for x in published.area_uncertainty_terms(spark, path).select("reach", "node", "detected", "fraction", "composite", "width_u").collect())
    assert got == _sql(path, SQL["area_uncertainty_terms"]) and got[0][2] > 0 and got[1][2:] == (None,) * 4


def test_a_pixel_given_for_two_reaches_keeps_the_nearest_node(spark, tmp_path):
    rows = [(1, 5, 1, 2, 10.0, 20000.0, "N"), (1, 6, 2, 2, 11.0, 20000.0, "N"), (1, 6, 2, 3, 11.0, 20000.0, "N"), (2, 6, 2, 3, 11.0, 98000.0, "N")]
    path = _lineitem(spark, tmp_path, rows, supplier=([(1,), (2,)], "s_suppkey long"))
    got = sorted(tuple(x) for x in catalogue.channel_filter(spark, path).collect())
    assert got == _sql(path, SQL["channel_filter"]) and len(got) == 2


def test_science_counts_nodes_without_copies_of_the_pixels(spark, tmp_path):
    rows = [(k, k % 50, 3 + k % 2, 1 + k % 7, 10.0 + k % 9, 9000.0 + 997 * (k % 40), "A" if k % 2 else "N") for k in range(400)]
    path = _lineitem(spark, tmp_path, rows)
    for name in ("science_bounds", "science_bound_counts"):
        out = getattr(published, name)(spark, path)
        assert sorted(tuple(x) for x in out.collect()) == _sql(path, SQL[name])
        assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
