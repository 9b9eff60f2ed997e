"""Fits that need all nodes of a reach at once (some hundred): NumPy kernels over batches of whole reaches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def wls(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> tuple[float, float]:
    """(slope, intercept); null-like results for fewer than two different x."""
    w = np.ones(len(x)) if w is None else w
    if len(x) < 2 or np.ptp(x) == 0 or w.sum() == 0:
        return np.nan, np.nan
    mx, my = np.average(x, weights=w), np.average(y, weights=w)
    slope = (w * (x - mx) * (y - my)).sum() / (w * (x - mx) ** 2).sum()
    return float(slope), float(my - slope * mx)


def robust_line(rows: DataFrame, key: list[str], x: str, y: str) -> DataFrame:
    """OLS slope and intercept with heteroscedasticity-robust (HC0) standard errors, all in aggregates: the second pass joins the line back."""
    from .aggregates import line

    rows = rows.select(*key, x, y)
    slope, intercept = line(F.col(x), F.col(y))
    fit = rows.groupBy(*key).agg(slope.alias("slope"), intercept.alias("intercept"), F.avg(x).alias("_mx"), F.count(y).alias("n"))
    e = F.col(y) - F.col("intercept") - F.col("slope") * F.col(x)
    d = F.col(x) - F.col("_mx")
    return (
        rows.join(fit, key)
        .groupBy(*key)
        .agg(F.first("slope").alias("slope"), F.first("intercept").alias("intercept"), F.first("n").alias("n"), (F.sqrt(F.sum(d * d * e * e)) / F.sum(d * d)).alias("slope_std"))
    )


def weighted_line(rows: DataFrame, key: list[str], x: str, y: str, w: str) -> DataFrame:
    """key, slope, intercept and n of a weighted line: weighted means first, then centred sums, which don't cancel. Null without two different x."""
    rows = rows.select(*key, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), F.col(w).cast("double").alias("_w")).dropna(subset=["_x", "_y", "_w"])
    means = rows.groupBy(*key).agg((F.sum(F.col("_w") * F.col("_x")) / F.sum("_w")).alias("_mx"), (F.sum(F.col("_w") * F.col("_y")) / F.sum("_w")).alias("_my"))
    dx, dy = F.col("_x") - F.col("_mx"), F.col("_y") - F.col("_my")
    sums = rows.join(means, key).groupBy(*key).agg(F.first("_mx").alias("_mx"), F.first("_my").alias("_my"), F.sum(F.col("_w") * dx * dx).alias("_xx"), F.sum(F.col("_w") * dx * dy).alias("_xy"), F.count("*").alias("n"))
    slope = F.col("_xy") / F.nullif(F.col("_xx"), F.lit(0.0))
    return sums.select(*key, slope.alias("slope"), (F.col("_my") - slope * F.col("_mx")).alias("intercept"), "n")


def by_reach(rows: DataFrame, columns: list[str], kernel: Callable[..., dict[str, np.ndarray] | list[dict[str, np.ndarray]]], schema: str, together: bool = False) -> DataFrame:
    """kernel(arrays of columns) for every reach_id; its arrays become rows. The first of columns orders a reach's rows. A kernel for reaches together gets a list of many reaches' arrays.

    Reaches are dealt to partitions and come sorted, so a call of Python serves a batch of many reaches; a reach is some hundred rows. Rows
    without a reach belong to none and are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(tables: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(tables)
            ids = table["reach_id"].to_numpy()
            edges = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            values = [table[c].to_numpy(zero_copy_only=False) for c in columns]
            reaches = [tuple(v[i:j] for v in values) for i, j in zip(edges[:-1], edges[1:], strict=True)]
            out = []
            for i, found in zip(edges[:-1], kernel(reaches) if together else (kernel(*r) for r in reaches), strict=True):
                n = len(next(iter(found.values())))
                out.append({"reach_id": np.full(n, ids[i]), **found})
            yield pa.record_batch({k: pa.array(np.concatenate([o[k] for o in out]), from_pandas=True) for k in out[0]})

        for batch in batches:
            if not len(batch):
                continue
            ids = batch.column("reach_id").to_numpy()
            last = int(np.flatnonzero(ids != ids[-1]).max(initial=-1)) + 1  # the last reach may go on in the next batch
            if held and held[-1].column("reach_id")[0].as_py() != ids[0]:
                yield from done(held)
                held = []
            if last:
                yield from done([*held, batch.slice(0, last)])
                held = []
            held.append(batch.slice(last))
        if held:
            yield from done(held)

    # a number of partitions that is told stays: rows are few for their work, so joining partitions by their size would leave most cores idle
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.where("reach_id is not null").select("reach_id", *columns).repartition(parts, "reach_id").sortWithinPartitions("reach_id", columns[0]).mapInArrow(run, f"reach_id long, {schema}")


def smooth(s: np.ndarray, y: np.ndarray, window: float, sigma: float, u: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian moving average by distance within a window and the deviation that it passes on; NaN values carry no weight. O(n) windows of a sorted s."""
    ok = np.isfinite(y)
    out, spread = np.full(len(s), np.nan), np.full(len(s), np.nan)
    u = np.zeros(len(s)) if u is None else u
    low, high = np.searchsorted(s, s - window / 2, "left"), np.searchsorted(s, s + window / 2, "right")
    for k, (i, j) in enumerate(zip(low.tolist(), high.tolist(), strict=True)):
        w = np.exp(-0.5 * ((s[i:j] - s[k]) / sigma) ** 2) * ok[i:j]
        if w.sum() > 0:
            out[k] = (w * np.nan_to_num(y[i:j])).sum() / w.sum()
            spread[k] = np.sqrt((w * w * u[i:j] ** 2)[ok[i:j]].sum()) / w.sum()
    return out, spread


# The systematic parts (m, m/m) of the uncertainties of heights and slopes.
HEIGHT_FLOOR, SLOPE_FLOOR = 0.09, 3e-6


def enhanced_slope(nodes: DataFrame, min_sigma: float = 1000.0, max_window: float = 10000.0, ratio: float = 5.0) -> DataFrame:
    """reach_id, slope, slope_r_u, slope_u: detrended heights are smoothed, the line is put back, the ends give the slope. Columns reach_id, s, wse, wse_u.

    slope_r_u propagates the deviations of the nodes through both ends' weights, of which those in both windows count as covariance.
    """

    def kernel(s, y, u) -> dict[str, np.ndarray]:
        ok = np.isfinite(s) & np.isfinite(y)
        s, y, u = s[ok], y[ok], np.nan_to_num(u[ok])
        slope, intercept = wls(s, y)
        r_u = np.nan
        if np.isfinite(slope):
            length = s[-1] - s[0]
            window = min(max_window, length)
            sigma = max(min_sigma, window / ratio)
            level = smooth(s, y - slope * s - intercept, window, sigma)[0] + slope * s + intercept
            slope = (level[-1] - level[0]) / length
            first, last = (np.where(np.abs(s - e) <= window / 2, np.exp(-0.5 * ((s - e) / sigma) ** 2), 0) for e in (s[0], s[-1]))
            r_u = np.sqrt(((first / first.sum() - last / last.sum()) ** 2 * u * u).sum()) / length
        return {"slope": np.array([slope]), "slope_r_u": np.array([r_u]), "slope_u": np.array([np.hypot(r_u, SLOPE_FLOOR)])}

    return by_reach(nodes, ["s", "wse", "wse_u"], kernel, "slope double, slope_r_u double, slope_u double")


def reconstructed(s: np.ndarray, y: np.ndarray, u: np.ndarray, prior: np.ndarray | None, tau: float, alpha: float, noise_power: int) -> tuple[np.ndarray, np.ndarray]:
    """Heights at all nodes and their covariance, given observed heights y (NaN where none) with deviations u.

    The prior is the weighted line of the observed nodes, or the heights told; its covariance falls off exponentially with distance. Observation noise
    has the deviations to the power noise_power on its diagonal: 1 as the published processing has it, 2 for variances.
    """
    seen = np.isfinite(y) & np.isfinite(u) & (u > 0)
    if prior is None or not np.isfinite(prior).all():
        slope, intercept = wls(s[seen], y[seen], 1 / u[seen] ** 2)
        prior = slope * s + intercept
    cov = alpha**2 * np.exp(-np.abs(s[:, None] - s[None, :]) / tau)
    gain = np.linalg.solve(cov[np.ix_(seen, seen)] + np.diag(u[seen] ** noise_power), cov[seen]).T
    return prior + gain @ (y[seen] - prior[seen]), cov - gain @ cov[seen]


def bayes_slope(nodes: DataFrame, tau: float = 10000.0, alpha: float = 1.0, noise_power: int = 1, prior: str | None = None) -> DataFrame:
    """reach_id, slope, height, slope_u, height_u: from heights reconstructed at all nodes. Columns reach_id, s, wse, wse_u and, if told, prior.

    The slope joins the end nodes, the height is the mean. Their uncertainties are the quadratic forms of the covariance, scaled by 1e-4 and 1e-2 as
    published, without a root. Null without two observed nodes.
    """

    def kernel(s, y, u, p=None) -> dict[str, np.ndarray]:
        out = np.full(4, np.nan)
        seen = np.isfinite(y) & np.isfinite(u) & (u > 0)
        if seen.sum() > 1 and np.ptp(s[seen]) > 0:
            level, cov = reconstructed(s, y, u, p, tau, alpha, noise_power)
            ends = cov[0, 0] + cov[-1, -1] - 2 * cov[0, -1]
            out[:] = (level[-1] - level[0]) / (s[-1] - s[0]), level.mean(), ends * 1e-4, cov.sum() * 1e-2
        return {n: out[k : k + 1] for k, n in enumerate(("slope", "height", "slope_u", "height_u"))}

    rows = nodes.dropna(subset=["s"])
    return by_reach(rows, ["s", "wse", "wse_u", *([prior] if prior else [])], kernel, "slope double, height double, slope_u double, height_u double")


def last_cut(off: np.ndarray, absolute: float, upper: float) -> np.ndarray:
    """Which distances stay: below the upper percentile, or below the absolute bound if that is larger."""
    return off < max(np.percentile(off, upper), absolute)


def iterative_line(s: np.ndarray, y: np.ndarray, w: np.ndarray, absolute: float, share: float = 68.0, upper: float = 80.0, rounds: int = 3) -> np.ndarray:
    """Which nodes are good: a line is refitted, with weights, to the nodes near the last one; distances are always those of all nodes.

    A node is near below the share's percentile or the absolute bound; if that keeps no more than upper percent, all below the upper percentile are.
    """
    slope, intercept = wls(s, y)
    for _ in range(rounds):
        off = np.abs(y - slope * s - intercept)
        near = off < max(np.percentile(off, share), absolute)
        if near.mean() * 100 <= upper:
            near = off < np.percentile(off, upper)
        slope, intercept = wls(s[near], y[near], w[near] if np.isfinite(w).all() else None)
        if not np.isfinite(slope):
            return near
    return last_cut(np.abs(y - slope * s - intercept), absolute, upper)


def reach_bound(s: np.ndarray, y: np.ndarray, w: np.ndarray, per_km: float) -> float:
    """The absolute bound of a reach: per_km times its height change over a kilometre."""
    slope, _ = wls(s, y, w)
    return abs(slope * 1000 * per_km) if np.isfinite(slope) else 0.0


def linear_outliers(nodes: DataFrame, absolute: float | None = 10.0, per_km: float = 1.5, share: float = 68.0, upper: float = 80.0, rounds: int = 3) -> DataFrame:
    """reach_id, node_id, good, by iterative_line. Columns reach_id, node_id, s, wse, wse_u; without absolute the bound is that of the reach.

    Nodes without a height or weight are not good; a reach of fewer than three such nodes has none that is.
    """

    def kernel(s, node, y, u) -> dict[str, np.ndarray]:
        w = np.where(np.isfinite(u) & (u > 0), 1 / np.maximum(u, 1e-6) ** 2, 0)
        ok = np.isfinite(s) & np.isfinite(y) & (w > 0)
        good = np.zeros(len(s), bool)
        if ok.sum() > 2 and np.ptp(s[ok]) > 0:
            bound = reach_bound(s[ok], y[ok], w[ok], per_km) if absolute is None else absolute
            good[ok] = iterative_line(s[ok], y[ok], w[ok], bound, share, upper, rounds)
        return {"node_id": node, "good": good}

    return by_reach(nodes, ["s", "node_id", "wse", "wse_u"], kernel, "node_id long, good boolean")


class BrokenLines:
    """Continuous lines with breaks, one for each of many reaches, fitted by weighted least squares: the slopes change at breaks that are moved until they settle.

    Points are padded with ones of no weight to those of the longest reach. All fits of a round are solved in one call; of names which reach each is of.
    """

    def __init__(self, points: list[tuple[np.ndarray, np.ndarray, np.ndarray]], apart: list[float], edge: list[float]):
        self.n = np.array([len(x) for x, _, _ in points])
        self.x, self.y, self.root = (np.zeros((len(points), self.n.max() + 1)) for _ in range(3))
        for i, (x, y, w) in enumerate(points):
            self.x[i, : len(x)], self.y[i, : len(x)], self.root[i, : len(x)] = x, y, np.sqrt(w)
        self.low, self.high = (np.array([np.quantile(x, e if low else 1 - e) for (x, _, _), e in zip(points, edge, strict=True)]) for low in (True, False))
        self.apart = np.array([a * np.ptp(x) for (x, _, _), a in zip(points, apart, strict=True)])

    def solve(self, of: np.ndarray, breaks: np.ndarray, picks: np.ndarray | None = None, moves: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """For each row of breaks, on all points or those picked for it: coefficients (with moves also of jumps at the breaks) and the sum of squares left."""
        x, y, root = (v[of] if picks is None else v[of[:, None], picks] for v in (self.x, self.y, self.root))
        k = breaks.shape[1]
        m = 2 + k * (1 + moves)
        past, a = x[:, :, None] - breaks[:, None], np.empty((*x.shape, m + 1))
        a[..., 0], a[..., 1], a[..., 2 : 2 + k], a[..., m] = 1, x, np.maximum(past, 0), y
        if moves:
            a[..., 2 + k : m] = -(past > 0).astype(float)
        a *= root[:, :, None]
        # the triangle of the columns and y holds all; where columns nearly depend on others, lstsq takes the least coefficients
        r = np.linalg.qr(a, mode="r")
        c, left, fine = np.empty((len(a), m)), np.empty(len(a)), np.zeros(len(a), bool)
        if r.shape[1] > m:
            square = r[:, :m, :m]
            fine = (np.abs(square.diagonal(axis1=1, axis2=2)) > 1e-7 * np.sqrt((square * square).sum(axis=1))).all(axis=1)
            c[fine], left[fine] = np.linalg.solve(square[fine], r[fine, :m, m:])[..., 0], r[fine, m, m] ** 2
        for i in np.flatnonzero(~fine):
            own = a[i, : self.n[of[i]]]
            c[i] = np.linalg.lstsq(own[:, :m], own[:, m], rcond=None)[0]
            left[i] = ((own[:, m] - own[:, :m] @ c[i]) ** 2).sum()
        return c, left

    def settle(self, of: np.ndarray, breaks: np.ndarray, picks: np.ndarray | None = None, rounds: int = 30) -> np.ndarray:
        """For each row of breaks those where the fit's jumps vanish; NaN if they leave the range, come too close or don't settle."""
        k, live, out = breaks.shape[1], np.arange(len(breaks)), np.full(breaks.shape, np.nan)
        for _ in range(rounds):
            if not len(live):
                break
            c, _ = self.solve(of, breaks, picks, True)
            low, high = self.low[of], self.high[of]
            with np.errstate(divide="ignore", invalid="ignore"):
                moved = np.sort(breaks + c[:, 2 + k :] / c[:, 2 : 2 + k], axis=1)
            bad = (c[:, 2 : 2 + k] == 0).any(axis=1) | (moved[:, 0] < low) | (moved[:, -1] > high) | (moved[:, 1:] - moved[:, :-1] < self.apart[of, None]).any(axis=1)
            done = ~bad & (np.abs(moved - breaks).max(axis=1) < 1e-5 * (high - low))
            out[live[done]] = moved[done]
            on = ~bad & ~done
            of, breaks, live, picks = of[on], moved[on], live[on], picks if picks is None else picks[on]
        return out

    def fit(self, reaches: np.ndarray, k: int, boots: int, rounds: int) -> list[np.ndarray | None]:
        """For each of reaches the values of the best fit with k breaks; restarts from fits to resampled points, drawn by a seed from the data."""
        low, high = self.low[reaches], self.high[reaches]
        start = np.linspace(low, high, k + 2, axis=1)[:, 1:-1] if k == 1 else np.linspace(low, high, k, axis=1)
        settled = self.settle(reaches, start, rounds=rounds)
        found = np.isfinite(settled).all(axis=1)
        best, least = np.where(found[:, None], settled, start), np.full(len(reaches), np.inf)
        if found.any():
            least[found] = self.solve(reaches[found], best[found])[1]
        picks = np.full((boots, len(reaches), self.x.shape[1]), self.x.shape[1] - 1)
        for i, reach in enumerate(reaches.tolist()):
            n = self.n[reach]
            draw = np.random.default_rng(abs(int(np.nanmean(self.y[reach, :n]) * 1e6)) % 2**32)
            for boot in range(boots):
                picks[boot, i, :n] = draw.integers(0, n, n)
        for pick in picks:  # a sample starts from the best fit so far
            sampled = self.settle(reaches, best, pick, rounds)
            at = np.flatnonzero(np.isfinite(sampled).all(axis=1))
            again = self.settle(reaches[at], sampled[at], rounds=rounds)
            ok = np.isfinite(again).all(axis=1)
            at, again = at[ok], again[ok]
            if len(at):
                left = self.solve(reaches[at], again)[1]
                better = left < least[at]
                best[at[better]], least[at[better]], found[at[better]] = again[better], left[better], True
        out: list[np.ndarray | None] = [None] * len(reaches)
        if found.any():
            c = self.solve(reaches[found], best[found])[0]
            for i, own, breaks in zip(np.flatnonzero(found).tolist(), c, best[found], strict=True):
                x = self.x[reaches[i], : self.n[reaches[i]]]
                out[i] = own[0] + own[1] * x + np.maximum(x[:, None] - breaks, 0) @ own[2:]
        return out


#: Points, with those that pad them, of the reaches that are fitted together.
TOGETHER = 10_000


def piecewise_good(reaches: list[tuple[np.ndarray, ...]], upper: float, apart: float, edge: float, boots: int, rounds: int) -> list[np.ndarray]:
    """Which nodes are good, of each reach (s, y, w, quality, absolute): near a broken line with as many breaks as settle, from one for each ten nodes less one downwards, else near a plain one.

    Nodes count 4, 3, 2 or 1 times by their quality, 0 to 3. Reaches of like length are fitted together.
    """
    levels: list[np.ndarray | None] = [None] * len(reaches)
    order = [i for i in sorted(range(len(reaches)), key=lambda i: len(reaches[i][0])) if len(reaches[i][0]) > 10]
    while order:
        held = max(1, TOGETHER // len(reaches[order[-1]][0]))  # the longest of those left
        ids, order = order[-held:], order[:-held]
        share = lambda v, i: v if 0 < v < 1 else v / len(reaches[i][0])
        points = [(reaches[i][0], reaches[i][1], np.clip(4 - np.nan_to_num(reaches[i][3], nan=3.0), 1, 4)) for i in ids]
        lines = BrokenLines(points, [share(apart, i) for i in ids], [share(edge, i) for i in ids])
        for k in range(int(lines.n.max()) // 10 - 1, 0, -1):
            asked = np.array([a for a, i in enumerate(ids) if levels[i] is None and lines.n[a] // 10 - 1 >= k], np.int64)
            if len(asked):
                for a, level in zip(asked.tolist(), lines.fit(asked, k, boots, rounds), strict=True):
                    levels[ids[a]] = level
    return [iterative_line(s, y, w, absolute, 68.0, upper, 3) if level is None else last_cut(np.abs(y - level), absolute, upper) for (s, y, w, _, absolute), level in zip(reaches, levels, strict=True)]


def piecewise_outliers(
    nodes: DataFrame, absolute: float | None = 10.0, per_km: float = 1.5, upper: float = 80.0, apart: float = 0.1, edge: float = 0.1, boots: int = 10, rounds: int = 30
) -> DataFrame:
    """reach_id, node_id, good, by piecewise_good. Columns reach_id, node_id, s, wse, wse_u and node_q; without node_q all nodes count alike.

    apart and edge are the least distances of breaks from each other and from the ends, as shares of the reach if below 1, else in nodes.
    """

    def kernel(reaches: list[tuple[np.ndarray, ...]]) -> list[dict[str, np.ndarray]]:
        masks, fitted, asked = [], [], []
        for s, _, y, u, q in reaches:
            w = np.where(np.isfinite(u) & (u > 0), 1 / np.maximum(u, 1e-6) ** 2, 0)
            ok = np.isfinite(s) & np.isfinite(y) & (w > 0)
            masks.append(np.zeros(len(s), bool))
            if ok.sum() > 2 and np.ptp(s[ok]) > 0:
                bound = reach_bound(s[ok], y[ok], w[ok], per_km) if absolute is None else absolute
                fitted.append((s[ok], y[ok], w[ok], q[ok].astype(float), bound))
                asked.append((masks[-1], ok))
        for (mask, ok), good in zip(asked, piecewise_good(fitted, upper, apart, edge, boots, rounds), strict=True):
            mask[ok] = good
        return [{"node_id": r[1], "good": mask} for r, mask in zip(reaches, masks, strict=True)]

    if "node_q" not in nodes.columns:
        nodes = nodes.withColumn("node_q", F.lit(0))
    return by_reach(nodes, ["s", "node_id", "wse", "wse_u", "node_q"], kernel, "node_id long, good boolean", together=True)


def flow_distance(nodes: DataFrame, key: list[str], order: list[str], length: str) -> DataFrame:
    """Cumulative length along the reach, centred on it."""
    w = Window.partitionBy(*key)
    upto = F.sum(length).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return nodes.withColumn("s", upto).withColumn("s", F.col("s") - F.avg("s").over(w))


def spline_resample(x: np.ndarray, y: np.ndarray, ds: float) -> pd.DataFrame:
    """Centerline: duplicates (under 1e-6) go, a not-a-knot cubic in distance is sampled at (i + 1/2) ds, with unit tangents."""
    keep = np.concatenate(([True], np.hypot(np.diff(x), np.diff(y)) > 1e-6))
    x, y = x[keep], y[keep]
    s = np.concatenate(([0], np.cumsum(np.hypot(np.diff(x), np.diff(y)))))
    at = (np.arange(int(s[-1] / ds)) + 0.5) * ds
    px, dx = cubic(s, x, at)
    py, dy = cubic(s, y, at)
    norm = np.hypot(dx, dy)
    return pd.DataFrame({"s": at, "x": px, "y": py, "tx": dx / norm, "ty": dy / norm})


def cubic(s: np.ndarray, v: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and slopes of the not-a-knot cubic spline (a line or parabola for fewer than four points)."""
    n = len(s)
    if n < 4:
        p = np.polyfit(s, v, n - 1)
        return np.polyval(p, at), np.polyval(np.polyder(p), at)
    h, d = np.diff(s), np.diff(v) / np.diff(s)
    a, b = np.zeros((n, n)), np.zeros(n)
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        b[i] = 6 * (d[i] - d[i - 1])
    a[0, :3] = h[1], -(h[0] + h[1]), h[0]
    a[-1, -3:] = h[-1], -(h[-2] + h[-1]), h[-2]
    m = np.linalg.solve(a, b)
    k = np.clip(np.searchsorted(s, at) - 1, 0, n - 2)
    t = at - s[k]
    c1 = d[k] - h[k] * (2 * m[k] + m[k + 1]) / 6
    c3 = (m[k + 1] - m[k]) / (6 * h[k])
    return v[k] + c1 * t + m[k] / 2 * t**2 + c3 * t**3, c1 + m[k] * t + 3 * c3 * t**2


def centerlines(vertices: DataFrame, ds: float) -> DataFrame:
    """reach_id, vertex_id and resampled s, x, y, tx, ty from reach_id, seq, x, y. Reaches of one place have no row."""

    def kernel(seq: np.ndarray, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        apart = len(x) > 1 and np.hypot(x - x[0], y - y[0]).max() > 1e-6
        out = spline_resample(x, y, ds) if apart else pd.DataFrame({k: np.zeros(0) for k in ("s", "x", "y", "tx", "ty")})
        return {"vertex_id": np.arange(len(out)), **{k: out[k].to_numpy() for k in out}}

    return by_reach(vertices.dropna(subset=["x", "y"]), ["seq", "x", "y"], kernel, "vertex_id long, s double, x double, y double, tx double, ty double")
