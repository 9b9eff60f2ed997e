"""Centerlines moved to the water: nodes go to the centres of their pixels, a weighted smoothing spline lays the line anew, until it settles."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from . import fits, rings

_TINY = 1e-6


def smoothing_spline(s: np.ndarray, v: np.ndarray, w: np.ndarray, allowed: float) -> np.ndarray:
    """The smoothest curve (least integral of the squared second derivative) whose weighted squared distance from v is at most allowed, at s.

    Natural cubic splines fulfil it; how much is smoothed is found by bisection, as the distance grows with it. If a straight line is near enough, it is the curve.
    """
    n = len(s)
    if n < 3:
        return v.copy()
    h = np.diff(s)
    q = np.zeros((n, n - 2))
    k = np.arange(n - 2)
    q[k, k], q[k + 1, k], q[k + 2, k] = 1 / h[:-1], -1 / h[:-1] - 1 / h[1:], 1 / h[1:]
    r = np.diag((h[:-1] + h[1:]) / 3) + np.diag(h[1:-1] / 6, 1) + np.diag(h[1:-1] / 6, -1)
    d = 1 / w**2

    def at(p: float) -> tuple[np.ndarray, float]:
        gamma = np.linalg.solve(r + p * (q.T * d) @ q, q.T @ v)
        off = p * d * (q @ gamma)
        return v - off, float((off**2 / d).sum())

    slope, intercept = fits.wls(s, v, w**2)
    line = slope * s + intercept
    if ((line - v) ** 2 / d).sum() <= allowed:
        return line
    low, high = -30.0, 30.0
    for _ in range(80):
        middle = (low + high) / 2
        if at(10.0**middle)[1] <= allowed:
            low = middle
        else:
            high = middle
    return at(10.0**low)[0]


def _line(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit tangents at the vertices."""
    s = np.concatenate(([0], np.cumsum(np.maximum(np.hypot(np.diff(x), np.diff(y)), _TINY))))
    if len(s) < 2:
        return np.ones(len(s)), np.zeros(len(s))
    (_, dx), (_, dy) = fits.cubic(s, x, s), fits.cubic(s, y, s)
    norm = np.maximum(np.hypot(dx, dy), _TINY)
    return dx / norm, dy / norm


def _weights(spread: np.ndarray) -> np.ndarray:
    most = spread.max() if spread.max() > 0 else 1.0
    return np.where(spread > 0, 1 / (spread + _TINY), 1 / most)


def refine_centerlines(pixels: DataFrame, nodes: DataFrame, max_width: float = 600.0, rounds: int = 1, alpha: float = 1.0, tol: float = 1.0, smooth: float | None = 1e-2) -> DataFrame:
    """reach_id, node_id, x, y, tx, ty, moves and change of the nodes after at most rounds moves.

    pixels: reach_id, pixel_id, x, y. nodes: reach_id, node_id, x, y, tx, ty. In a round every pixel within max_width / 2 across the line goes to its reach's nearest node (the
    lower one on ties); nodes move to (1 - alpha) of their place and alpha of their pixels' mean. Nodes without pixels go. A reach whose greatest change is below tol
    is done and stays as it is; change is the last one measured, moves how often the reach moved. With smooth, the places are smoothed along the reach, each coordinate
    with its pixels' deviations as weights, to a weighted squared distance of smooth for each node. Rounds are written tables; only reaches that still move are read again.
    Their files are small for their rows, so their joins are told not to broadcast.
    """
    lines = written(nodes.select("reach_id", "node_id", "x", "y", "tx", "ty").withColumns({"moves": F.lit(0), "change": F.lit(None).cast("double")}), "refine")
    pixels = pixels.select("reach_id", "pixel_id", "x", "y")
    done: list[DataFrame] = []

    def kernel(node, x, y, xc, yc, xs, ys) -> dict[str, np.ndarray]:
        change = max(np.abs(xc - x).max(), np.abs(yc - y).max())
        px, py = (1 - alpha) * x + alpha * xc, (1 - alpha) * y + alpha * yc
        if smooth is not None and len(px) > 3:
            s = np.concatenate(([0], np.cumsum(np.maximum(np.hypot(np.diff(px), np.diff(py)), _TINY))))
            px, py = (smoothing_spline(s, v, _weights(u), smooth * len(s)) for v, u in ((px, xs), (py, ys)))
        tx, ty = _line(px, py)
        return {"node_id": node, "px": px, "py": py, "ptx": tx, "pty": ty, "now": np.full(len(node), change)}

    for _ in range(rounds):
        cell = max_width  # half the width across, and as much along as between neighbouring nodes
        held = lines.select("reach_id", "node_id", F.col("x").alias("nx"), F.col("y").alias("ny"), "tx", "ty")
        near = rings.nearest_within_cell(pixels, held, cell, ["node_id", "nx", "ny", "tx", "ty"], by=["reach_id"])
        across = F.abs((F.col("y") - F.col("b.ny")) * F.col("b.tx") - (F.col("x") - F.col("b.nx")) * F.col("b.ty"))
        near = near.where(across <= max_width / 2).groupBy("reach_id", F.col("b.node_id").alias("node_id"))
        centres = near.agg(F.avg("x").alias("xc"), F.avg("y").alias("yc"), F.stddev_pop("x").alias("xs"), F.stddev_pop("y").alias("ys"))
        asked = lines.select("reach_id", "node_id", "x", "y").join(centres.hint("merge"), ["reach_id", "node_id"])
        moved = fits.by_reach(asked, ["node_id", "x", "y", "xc", "yc", "xs", "ys"], kernel, "node_id long, px double, py double, ptx double, pty double, now double")
        lines = written(lines.join(moved.hint("merge"), ["reach_id", "node_id"]), "refine")
        still = F.col("now") < tol
        done.append(lines.where(still).select("reach_id", "node_id", "x", "y", "tx", "ty", "moves", F.col("now").alias("change")))
        lines = lines.where(~still).select("reach_id", "node_id", F.col("px").alias("x"), F.col("py").alias("y"), F.col("ptx").alias("tx"), F.col("pty").alias("ty"), (F.col("moves") + 1).alias("moves"), F.col("now").alias("change"))
        if not lines.take(1):
            break
    return functools.reduce(DataFrame.unionByName, [*done, lines])
