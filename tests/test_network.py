"""Networks of reaches, two-pass assignment, rings, labels and refinement against independent versions."""

import random
from collections import Counter, deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluvion.operators import fits, graph, labels, network, refine, rings, two_pass
from fluvion.plans import assignment, catalogue, lines  # noqa: F401


def test_shared_vertices_go_in_at_the_ends(spark):
    s = "reach_id long, cl_id long, x double, y double, is_extra boolean"
    line = [(1, k, 30.0 * k, 0.0, False) for k in range(10, 16)]
    extra = [(1, 4, 240.0, 0.0, True), (1, 5, 270.0, 5.0, True), (1, 20, 480.0, 0.0, True), (1, 21, 510.0, 0.0, True), (1, 30, 390.0, 300.0, True), (1, 31, 375.0, 0.0, True)]
    rows = {r.seq: r.cl_id for r in network.with_shared_ends(spark.createDataFrame([*line, *extra, (2, 1, 0.0, 0.0, True), (None, 1, 0.0, 0.0, False)], s)).collect()}
    # 4 is 60 m from the start, which 5 has not come before yet; 5, 20 and 21 each continue an end; 31 is 45 m from an inner vertex only
    assert [rows[k] for k in sorted(rows)] == [5, 10, 11, 12, 13, 14, 15, 20, 21]


def test_lookup_marks_vertices_of_others(spark):
    c = spark.createDataFrame([(1, 0.5, [7, 0, None, 0]), (2, 1.5, [7, 8, 0, 0]), (3, 2.5, [8, 7, 8, 0]), (4, 3.5, None)], "cl_id long, x double, reach_ids array<long>")
    got = {(r.reach_id, r.cl_id): (r.x, r.is_extra) for r in network.vertices_of(c).collect()}
    assert got == {(7, 1): (0.5, False), (7, 2): (1.5, False), (8, 2): (1.5, True), (8, 3): (2.5, True), (7, 3): (2.5, True)}
    assert network.vertices_of(c, spark.createDataFrame([(8,), (9,)], "reach_id long")).count() == 2


def test_neighbours_by_their_ends(spark):
    reaches = spark.createDataFrame([(11, [21], [31]), (21, [0], [11]), (31, [23, 11], []), (41, [31], [21]), (23, [], [])], "reach_id long, up array<long>, down array<long>")
    place = {11: (0, 0), 21: (1000, 0), 31: (-1000, 100), 41: (9000, 0), 23: (0, 100)}
    prior = spark.createDataFrame([(k, n, float(x + 100 * n), float(y), 100.0 * n) for k, (x, y) in place.items() for n in range(10)], "reach_id long, node_id long, x double, y double, s double")
    seen = spark.createDataFrame([(k, n, 3 if k == 31 and n < 4 else 1, 5.0) for k in place for n in range(10)], "reach_id long, node_id long, node_q long, wse double")
    got = {(r.reach_id, r.side): r.other for r in network.neighbours(reaches, prior, seen).collect()}
    assert got == {(11, 1): 21, (11, -1): 31, (21, -1): 11, (31, 1): 11}  # 23 is a lake, 41 is far away
    few = {(r.reach_id, r.side): r.other for r in network.neighbours(reaches, prior, seen, more_than=6).collect()}
    assert (11, -1) not in few and few[11, 1] == 21
    rows = network.stitched(reaches, prior, seen.where("not (reach_id = 11 and node_id = 3)")).where("reach_id = 11").orderBy("part", "node_id").collect()
    assert [r.part for r in rows] == [-1] * 10 + [0] * 10 + [1] * 10 and [r.ss for r in rows][9:12] == [900.0, 900.0, 1000.0]
    assert [r.wse for r in rows].count(None) == 1 and [r.ss for r in rows] == sorted(r.ss for r in rows)


def test_rings_find_the_nearest_however_far(spark):
    rng = np.random.default_rng(0)
    nodes = [(g, k, float(x), float(y)) for k, (x, y) in enumerate(rng.uniform(0, 5000, (40, 2))) for g in [k % 3]] + [(1, 99, 100.0, 100.0), (2, 98, 100.0, 100.0), (1, 97, 100.0, 100.0)]
    points = [(k, float(x), float(y)) for k, (x, y) in enumerate(rng.uniform(-20_000, 20_000, (200, 2)))] + [(500, 100.0, 100.0), (501, 100.0, 90.0), (502, None, 1.0)]
    n = spark.createDataFrame(nodes, "g long, node long, nx double, ny double")
    p = spark.createDataFrame(points, "id long, x double, y double")
    got = {}
    for r in rings.nearest(p, n, "id", 100.0, 1e6, group="g").collect():
        got.setdefault(r.id, set()).add((r.g, r.node, r.d2))
    for k, x, y in points[:-1]:
        d = {(g, m): (x - a) * (x - a) + (y - b) * (y - b) for g, m, a, b in nodes}
        least = min(d.values())
        want = {}
        for (g, m), v in sorted(d.items()):
            if v == least:
                want.setdefault(g, (g, m, v))
        assert got[k] == set(want.values())
    assert 502 not in got and len(got[500]) == 2
    assert {r.id for r in rings.nearest(p, n, "id", 100.0, 3000.0).collect()} == {k for k, x, y in points[:-1] if min((x - a) ** 2 + (y - b) ** 2 for _, _, a, b in nodes) <= 9e6}


def brute_two_pass(pixels, nodes, neighbours, w=600.0, min_obs=10, ext=False):
    """The reference's order of work for each reach in turn, over all pixels."""
    by = {}
    for row in nodes:
        by.setdefault(row[0], []).append(row)
    half = {}
    for k, rows in by.items():
        wide = [None if a is None or b is None else max(a, b) for *_, a, b, _, _ in [(r[0], r[7], r[8], r[9], r[10]) for r in rows]]
        known = [v for v in wide if v is not None]
        wide = [np.median(known) if v is None else v for v in wide]
        fill = np.median(wide)
        half[k] = [(fill if v <= 0 else v) * r[9] for v, r in zip(wide, rows, strict=True)]

    def projected(k, x, y):
        best = min(((x - r[2]) * (x - r[2]) + (y - r[3]) * (y - r[3]), i) for i, r in enumerate(by[k]))
        i = best[1]
        r = by[k][i]
        return best[0], i, (x - r[2]) * r[4] + (y - r[3]) * r[5], (y - r[3]) * r[4] - (x - r[2]) * r[5]

    at = {(p[0], k): projected(k, p[1], p[2]) for p in pixels for k in by}

    def mode(found):
        c = Counter(v for v in found if v > 0)
        return min((-n, v) for v, n in c.items())[1] if c else None

    main = {}
    for k in by:
        if len(by[k]) > 3:
            m = mode([p[3] for p in pixels if abs(at[p[0], k][3]) <= w / 2 and abs(at[p[0], k][2]) <= 600])
            if m is not None:
                main[k] = m
    channel = {}
    for k in sorted(by):
        near = {main[o] for a, o in neighbours if a == k and o in main} if k in main else set()
        lab = {p[0]: main[k] if p[3] in near else p[3] for p in pixels}
        inside = {p[0] for p in pixels if abs(at[p[0], k][3]) <= half[k][at[p[0], k][1]] and abs(at[p[0], k][2]) <= 600}
        m = mode([lab[i] for i in inside])
        if m is None:
            continue
        for p in pixels:
            far = 20 * max(200, half[k][at[p[0], k][1]])
            if lab[p[0]] == m and abs(at[p[0], k][2]) <= far and abs(at[p[0], k][3]) <= far:
                inside.add(p[0])
        channel[k] = inside
    out = {}
    for p in pixels:
        least = min(at[p[0], k][0] for k in by)
        for k in sorted(channel):
            if p[0] in channel[k] and at[p[0], k][0] <= least:
                out[p[0]] = k
    out = {i: k for i, k in out.items() if k % 10 != 6 and len(by[k]) > 1}

    def full(out):
        c = Counter((k, at[i, k][1]) for i, k in out.items())
        good = {k for (k, _), n in c.items() if n >= min_obs}
        return {i: k for i, k in out.items() if k in good}

    out = full(out)
    if ext:
        bound = lambda i, k: by[k][at[i, k][1]][10] * max(200, half[k][at[i, k][1]])
        out = full({i: k for i, k in out.items() if abs(at[i, k][2]) <= bound(i, k) and abs(at[i, k][3]) <= bound(i, k)})
    return {i: (k, by[k][at[i, k][1]][1]) for i, k in out.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_two_passes_equal_the_loop_over_reaches(spark, seed):
    r = random.Random(seed)
    nodes = []
    for k, (x, y, m) in {11: (0, 0, 7), 21: (1400, 0, 7), 31: (2800, 300, 6), 46: (300, 900, 5), 51: (2600, -900, 3), 61: (1500, 1800, 1)}.items():
        nodes += [(k, i, x + 200.0 * i, float(y), 1.0, 0.0, 200.0, r.choice([None, -5.0, 80.0, 150.0]), r.choice([-5.0, 90.0, 200.0]), r.choice([0.5, 1.0]), r.choice([1.0, 2.0])) for i in range(m)]
    pixels = [(i, r.uniform(-500, 4500), r.choice([r.gauss(0, 150), r.gauss(300, 200), r.uniform(-1500, 2500), 900.0]), r.choice([0, 1, 1, 2, 3])) for i in range(700)]
    pixels += [(9000 + i, 1300.0, float(3 * i), 1) for i in range(12)]  # as near to 11's last node as to 21's first
    near = [(11, 21), (21, 11), (21, 31), (31, 21)]
    a = spark.createDataFrame(pixels, "pixel_id long, x double, y double, label long")
    b = spark.createDataFrame(nodes, "reach_id long, node_id long, x double, y double, tx double, ty double, spacing double, width double, max_width double, wth_coef double, ext_dist_coef double")
    c = spark.createDataFrame(near, "reach_id long, neighbour long")
    for ext in (False, True):
        got = {x.pixel_id: (x.reach_id, x.node_id) for x in two_pass.assign_reaches(a, b, c, use_ext_dist_coef=ext).collect()}
        want = brute_two_pass(pixels, nodes, near, ext=ext)
        assert got == want and len({k for k, _ in want.values()}) >= 2


def test_nearest_within_cell_shuffles_points_once(spark):
    rng = np.random.default_rng(4)
    points = [(k % 300, float(x), float(y)) for k, (x, y) in enumerate(np.round(rng.uniform(0, 100, (300, 2))).tolist() * 2)]
    nodes = [(g, n, float(x), float(y)) for g in range(4) for n, (x, y) in enumerate(np.round(rng.uniform(0, 100, (12, 2))))]
    p, q = spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(nodes, "g long, n long, nx double, ny double")
    out = rings.nearest_within_cell(p, q, 30.0, ["n", "nx", "ny"], group="g")
    got = sorted((r.id, r.g, r.b.d2, r.b.n) for r in out.collect())
    best = {(i, g): min(((x - a) ** 2 + (y - b) ** 2, n) for h, n, a, b in nodes if h == g) for i, x, y in points for g in range(4)}
    assert got == sorted((*k, *v) for k, v in best.items() if v[0] <= 900)  # repeated points are one
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") <= 2  # points to their cells, nodes to lists


@pytest.mark.parametrize("name", ["two_pass_assignment", "centerline_refinement"])
def test_tables_that_grow_with_the_river_are_not_broadcast(spark, monkeypatch, name):
    """F2 to F6: node lists are many times the files that they are made of, on which plans choose; only the distinct labels of pixels may go to the driver."""
    plans = []
    for module in (rings, two_pass, refine):
        plain = module.written
        monkeypatch.setattr(module, "written", lambda df, table, plain=plain: plans.append((table, df._jdf.queryExecution().executedPlan().toString())) or plain(df, table))
    assert catalogue.QUERIES[name](spark, "/root/testdata/sf0.001").count()
    assert all("BroadcastExchange" not in plan for table, plan in plans if table not in ("ring", "pass-rows"))
    assert all(plan.count("+- BroadcastExchange") <= 1 for _, plan in plans) and len(plans) > 1


def test_two_passes_of_empty_tables(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, 1)], "pixel_id long, x double, y double, label long")
    b = spark.createDataFrame([], "reach_id long, node_id long, x double, y double, tx double, ty double, spacing double, width double, max_width double, wth_coef double, ext_dist_coef double")
    c = spark.createDataFrame([], "reach_id long, neighbour long")
    assert two_pass.assign_reaches(a, b, c).count() == 0 and two_pass.assign_reaches(a.where("false"), b, c).count() == 0


def test_graph_components_of_paths_stars_and_cycles(spark):
    r = random.Random(3)
    names = list(range(0, 3000, 3))
    r.shuffle(names)
    edges = [*zip(names[:400], names[1:401], strict=True), *((names[500], n) for n in names[501:700]), (names[700], names[700]), (names[701], names[702]), (names[702], names[701])]
    got = {x.node: x.component for x in graph.components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    want = {n: min(names[:401]) for n in names[:401]} | {n: min(names[500:700]) for n in names[500:700]} | {names[700]: names[700]} | {n: min(names[701:703]) for n in names[701:703]}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def flood(cells):
    """Component of each cell, by its first cell in scan order."""
    left, out = set(cells), {}
    for start in sorted(cells):
        if start in left:
            left.discard(start)
            todo = deque([start])
            while todo:
                a, b = todo.popleft()
                out[a, b] = start
                for o in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                    if o in left:
                        left.discard(o)
                        todo.append(o)
    return out


def numbers(found):
    order = {v: i + 1 for i, v in enumerate(sorted(set(found.values())))}
    return {k: order[v] for k, v in found.items()}


def brute_erosion(mask, n):
    kept = {c for c in mask if all((c[0] + i, c[1] + j) in mask for i, j in labels.diamond(n))}
    label = numbers(flood(kept))
    most = max(label.values(), default=0)
    for _ in range(n):
        new = {}
        for a, b in mask - set(label):
            near = [label[a + i, b + j] for i, j in labels.square(2) if (a + i, b + j) in label]
            if near:
                new[a, b] = max(near)
        label |= new
    orphans = mask - set(label)
    grown = {(a + i, b + j) for a, b in orphans for i, j in labels.diamond(1) if a + i >= 0 and b + j >= 0}
    parts = numbers(flood(grown))
    out = dict(label)
    for part in set(parts.values()):
        mine = [c for c, p in parts.items() if p == part]
        met = Counter(label[c] for c in mine if c in label)
        given = min((-k, v) for v, k in met.items())[1] if met else most + part
        out |= {c: given for c in mine if c in mask}
    return out


def test_labels_equal_brute_force_over_blocks(spark):
    r = random.Random(6)
    cells = [(a, b) for a in range(40) for b in range(50) if r.random() < 0.6]
    frame = spark.createDataFrame(cells + cells[:50], "az long, rg long").repartition(3)
    for block in (7, 16, 128):
        parts = labels.components(frame, block)
        got = {(x.az, x.rg): x.number for x in parts.join(labels.numbered(parts), "part").collect()}
        assert got == numbers(flood(cells))
    # blobs joined by thin bridges, and thin things
    mask = {(a, b) for a in range(60) for b in range(60) if (a // 10 + b // 10) % 2 == 0 and a % 10 < 7 and b % 10 < 7} | {(3, b) for b in range(40)} | {(58, b) for b in range(20, 50)} | {(35, 59), (15, 2)}
    for n in (1, 2):
        got = {(x.az, x.rg): x.label for x in labels.eroded_labels(spark.createDataFrame(sorted(mask), "az long, rg long"), n, block=13).collect()}
        assert got == brute_erosion(mask, n)
    assert labels.eroded_labels(spark.createDataFrame([], "az long, rg long"), 1).count() == 0


def test_water_labels_with_dilation_and_edges(spark):
    rows = [(0, 0, True), (0, 1, False), (0, 3, True), (2, 2, False), (5, 5, False), (0, 0, False), (3, 3, True)]
    p = spark.createDataFrame(rows, "az long, rg long, is_water boolean")
    assert {(x.az, x.rg): x.label for x in labels.water_labels(p).collect()} == {(0, 0): 1, (0, 1): 1, (0, 3): 2, (2, 2): 3, (5, 5): 0, (3, 3): 3}
    assert {(x.az, x.rg): x.label for x in labels.water_labels(p, dilation=1).collect()} == {(0, 0): 1, (0, 1): 1, (0, 3): 1, (2, 2): 1, (5, 5): 0, (3, 3): 1}


def test_labels_of_reaches_equal_brute_force(spark):
    rng = np.random.default_rng(9)
    pixels = [(int(k), float(x), float(y)) for k in range(1, 9) for x, y in rng.normal(rng.uniform(0, 3000, 2), 60, (50 if k != 3 else 10, 2))] + [(0, 1.0, 1.0)]
    nodes = [(k, n, float(x + 20 * n), float(y)) for k, (x, y) in enumerate(rng.uniform(-500, 3500, (12, 2))) for n in range(5)]
    p, q = spark.createDataFrame(pixels, "label long, x double, y double"), spark.createDataFrame(nodes, "reach_id long, node_id long, x double, y double")
    got = {x.reach_id: (x.label, x.distance) for x in labels.labels_of_reaches(p, q, cell=50.0, min_pixels=20).collect()}
    for k in range(12):
        mean = {v: np.mean([min(np.hypot(x - a, y - b) for w, a, b in pixels if w == v) for r, _, x, y in nodes if r == k]) for v in range(1, 9) if v != 3}
        assert got[k][0] == min(mean, key=mean.get) and got[k][1] == pytest.approx(min(mean.values()))
    some = {x.reach_id: x.label for x in labels.labels_of_reaches(p, q, cell=50.0, min_pixels=20, max_pixels=25).collect()}
    assert len(some) == 12 and sum(some[k] == got[k][0] for k in some) >= 9
    assert labels.labels_of_reaches(p.where("false"), q, cell=50.0).count() == 0


def test_many_blocks_are_labelled_in_a_call(spark):
    rng = np.random.default_rng(3)
    cells = sorted({(int(a), int(b)) for a, b in rng.integers(0, 60, (2200, 2))}, key=lambda x: (x[0] // 8, x[1] // 8))
    az, rg = (np.array(v) for v in zip(*cells, strict=True))
    out = labels._blocks(az // 8, rg // 8, az, rg, 8)
    got = {(a, b): p for a, b, p in zip(*(out[k].to_pylist() for k in ("az", "rg", "part")), strict=True)}
    want, held = {}, set(cells)
    for start in sorted(held):  # a flood within each block
        todo = [] if start in want else [start]
        while todo:
            a, b = todo.pop()
            want[a, b] = start[0] * (1 << 31) + start[1]
            todo += [(x, y) for x, y in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)) if (x, y) in held and (x, y) not in want and x // 8 == a // 8 and y // 8 == b // 8]
    assert got == want
    p = spark.createDataFrame(cells, "az long, rg long")
    assert {(x.az, x.rg): x.part for x in labels.components(p, block=8).collect()} == {(x.az, x.rg): x.part for x in labels.components(p, block=64).collect()}


def test_labels_of_reaches_take_all_pixels_and_meet_few(spark, monkeypatch):
    rng = np.random.default_rng(10)
    pixels = [(int(k), float(x), float(y)) for k in (1, 2, 3) for x, y in rng.uniform(0, 200, (1500, 2))]
    nodes = [(k, n, 40.0 * (k % 4) + 3 * n, 50.0) for k in range(40) for n in range(3)]
    p, q = spark.createDataFrame(pixels, "label long, x double, y double"), spark.createDataFrame(nodes, "reach_id long, node_id long, x double, y double")
    met = []
    plain = rings.within_cell
    monkeypatch.setattr(rings, "within_cell", lambda *a, **k: met.append(plain(*a, **k)) or met[-1])
    got = {x.reach_id: (x.label, x.distance) for x in labels.labels_of_reaches(p, q, cell=64.0, min_pixels=20, max_pixels=None).collect()}
    for k in range(40):
        mean = {v: np.mean([min(np.hypot(x - a, y - b) for w, a, b in pixels if w == v) for r, _, x, y in nodes if r == k]) for v in (1, 2, 3)}
        assert got[k][0] == min(mean, key=mean.get) and got[k][1] == pytest.approx(min(mean.values()))
    assert sum(m.count() for m in met) < 20_000  # all pixels around all nodes are some 160,000 pairs


def test_refinement_settles_on_a_shifted_line(spark):
    rng = np.random.default_rng(1)
    pixels = [(k, i, float(x), float(y)) for k, shift in ((1, 80.0), (2, 0.0)) for i, (x, y) in enumerate(zip(rng.uniform(-100, 3900, 4000), shift + rng.uniform(-50, 50, 4000), strict=True))]
    nodes = [(k, n, 200.0 * n, 0.0, 1.0, 0.0) for k in (1, 2) for n in range(20)]
    a, b = spark.createDataFrame(pixels, "reach_id long, pixel_id long, x double, y double"), spark.createDataFrame(nodes, "reach_id long, node_id long, x double, y double, tx double, ty double")
    rows = refine.refine_centerlines(a, b, rounds=6, tol=15.0, smooth=1e-1).collect()
    first = [x for x in rows if x.reach_id == 1]
    assert len(first) == 20 and max(abs(x.y - 80) for x in first) < 12 and {x.moves for x in first} == {1} and all(x.change < 15 for x in rows)
    assert {(x.moves, x.y) for x in rows if x.reach_id == 2} == {(0, 0.0)}  # it was done at once and stays as it is
    assert all(x.tx > 0.99 for x in rows)


def test_smoothing_keeps_to_what_is_allowed():
    rng = np.random.default_rng(2)
    s = np.cumsum(rng.uniform(0.5, 2, 80))
    v, w = np.sin(s / 8) + rng.normal(0, 0.1, 80), np.full(80, 10.0)
    for allowed in (1.0, 20.0, 80.0):
        f = refine.smoothing_spline(s, v, w, allowed)
        assert ((f - v) ** 2 * w**2).sum() == pytest.approx(allowed, rel=1e-3)
    assert np.abs(refine.smoothing_spline(s, v, w, 80.0) - np.sin(s / 8)).mean() < 0.06
    line = refine.smoothing_spline(s, v, w, 1e9)
    assert np.allclose(np.diff(line) / np.diff(s), (line[-1] - line[0]) / (s[-1] - s[0]))


def test_kernels_leave_out_rows_without_a_reach(spark):
    n = spark.createDataFrame([(None, 0.0, 1.0, 0.1), (1, 0.0, 1.0, 0.1), (1, 1000.0, 2.0, 0.1), (1, 2000.0, 3.0, 0.1)], "reach_id long, s double, wse double, wse_u double")
    rows = fits.bayes_slope(n).collect()
    assert [x.reach_id for x in rows] == [1] and rows[0].slope == pytest.approx(1e-3)
    assert fits.enhanced_slope(n.where(F.col("reach_id").isNull())).count() == 0
