"""Discharge models on rows of reaches. A model is null where its guards fail."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quality


def _guard(width: Column, slope: Column, base: Column, area: Column) -> Column:
    return (width > 0) & (slope > 0) & (base > 0) & (area >= 0)


def manning(width: Column, slope: Column, area: Column, n: Column) -> Column:
    return F.pow(area, 5 / 3) * F.pow(width, -2 / 3) * F.sqrt(slope) / n


def metroman(width: Column, slope: Column, d_area: Column, base: Column, n_inf: Column, p: Column) -> Column:
    n = n_inf * F.pow((d_area + base) / width, p)
    return F.when(_guard(width, slope, base, base + d_area) & (n_inf > 0), manning(width, slope, base + d_area, n))


def constant_n(width: Column, slope: Column, d_area: Column, base: Column, n: Column) -> Column:
    """BAM, SADS and SIC4DVar have this form."""
    return F.when(_guard(width, slope, base, base + d_area) & (n > 0), manning(width, slope, base + d_area, n))


def hivdi(width: Column, slope: Column, d_area: Column, base: Column, alpha: Column, beta: Column) -> Column:
    """By the inverse of the roughness, which is 0 for an empty section."""
    inverse = alpha * F.pow((d_area + base) / width, beta)
    return F.when(_guard(width, slope, base, base + d_area) & (alpha > 0), manning(width, slope, base + d_area, F.lit(1.0)) * inverse)


def momma(width: Column, slope: Column, height: Column, bed: Column, bankfull: Column, mean_slope: Column) -> Column:
    nb = 0.11 * F.pow(mean_slope, 0.18)
    part = F.log10((bankfull - bed) / F.nullif(height - bed, F.lit(0.0)))  # both branches take it, so it may be computed before the guard
    n = nb * F.when(height <= bankfull, 1 + part).otherwise(1 - part)
    ok = (width > 0) & (slope > 0) & (height > bed) & (mean_slope > 0) & (bankfull > bed)
    return F.when(ok & (n > 0), F.pow((height - bed) * 2 / 3, 5 / 3) * width * F.sqrt(slope) / n)


def split_uncertainty(random: Column, bias_share: Column) -> tuple[Column, Column]:
    """(systematic, total) from the random part and the systematic share of the total."""
    s = F.when((bias_share >= 0) & (bias_share < 1), bias_share * random / F.sqrt(1 - bias_share * bias_share))
    return s, F.sqrt(random * random + s * s)


def consensus(*models: Column) -> Column:
    """The median of the models that are there."""
    a = F.array_sort(F.array_compact(F.array(*models)))
    n = F.size(a)
    mid = (F.get(a, ((n - 1) / 2).cast("int")) + F.get(a, (n / 2).cast("int"))) / 2
    return F.when(n > 0, mid)


def consensus_uncertainty(*systematic: Column) -> Column:
    a = F.array_compact(F.array(*systematic))
    n = F.size(a)
    mean = F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / n
    return F.when(n > 0, F.sqrt(math.pi / 2 * mean * mean / n))


def bits(**failed: Column) -> Column:
    """Model bits: missing inputs and failed models, in the order given from bit 0 on."""
    total = F.lit(0).cast("long")
    for k, c in enumerate(failed.values()):
        total = total + F.when(c, 1 << k).otherwise(0)
    return total


def area_change(height: Column, breaks: tuple[Column, ...], lines: list[tuple[Column, Column]], median_area: Column) -> Column:
    """Change of the cross-section from its median: widths are linear in height by pieces (slope, intercept) and integrated from the lowest break up."""
    total: Column = F.lit(0.0)
    for k, (slope, intercept) in enumerate(lines):
        top = height if k == len(lines) - 1 else F.least(height, breaks[k + 1])
        piece = slope / 2 * (top * top - breaks[k] * breaks[k]) + intercept * (top - breaks[k])
        total = total + (F.when(height > breaks[k], piece).otherwise(0.0) if k else piece)
    return total - median_area


def flag(reach_q: Column, slope: Column, slope_u: Column, d_area: Column, bases: dict[str, Column], bed: Column, bankfull: Column, models: dict[str, Column]) -> Column:
    """The discharge flag of a reach: its quality, its slope, the cross-sections of the models (bases by name) and how many models have a value."""
    there = sum((m.isNotNull().cast("int") for m in models.values()), start=F.lit(0))
    tests = {
        "reach_suspect": reach_q == 1, "reach_degraded": reach_q == 2, "reach_bad": reach_q == 3, "big_slope_u": slope_u / F.nullif(slope, F.lit(0.0)) > 0.4, "negative_slope": slope < 0,
        "momma": bed > bankfull, "incomplete": (there > 0) & (there < len(models)), "none": there == 0, **{name: d_area + base < 0 for name, base in bases.items()},
    }
    return quality.flag(tests, quality.DISCHARGE_BITS)


def metroman_random(width: Column, width_u: Column, slope: Column, slope_u: Column, d_area: Column, d_area_u: Column, base: Column, p: Column) -> Column:
    """The relative random uncertainty of the model with a variable roughness; of the models of constant roughness for p = 0."""
    zero = F.lit(0.0)
    parts = ((p - 2 / 3) / F.nullif(width, zero) * width_u, (5 / 3 - p) / F.nullif(base + d_area, zero) * d_area_u, slope_u / F.nullif(2 * slope, zero))
    total = F.lit(0.0)
    for x in parts:
        total = total + x * x
    return F.sqrt(total)


def low_slope(width: Column, height: Column, d_area: Column, base: Column, n_inf: Column, p: Column) -> Column:
    """Discharge of reaches of low slope: a power of the height above the base, at the roughness of the section."""
    ok = (width > 0) & (base + d_area >= 0) & (base > 0) & (n_inf > 0) & (height >= base)
    return F.when(ok, n_inf * F.pow((d_area + base) / width, p) * F.pow(height - base, p))


def consensus_parts(models: list[Column], systematic: list[Column], random: list[Column]) -> dict[str, Column]:
    """q, its systematic and total uncertainty and the systematic share, over the models that have a value."""
    s = consensus_uncertainty(*systematic)
    total = F.sqrt(s * s + F.pow(consensus(*random), 2.0))
    return {"q": consensus(*models), "q_s_u": s, "q_u": total, "q_s_rel": s / F.nullif(total, F.lit(0.0))}


def _of_piece(values: list[Column], at: Column) -> Column:
    return F.get(F.array(*values), at)


def section_change(
    rows: DataFrame, height: Column, height_u: Column, width: Column, width_u: Column, breaks: list[Column], lines: list[tuple[Column, Column]], median_area: Column, width_var: Column, height_var: Column, spread: Column
) -> DataFrame:
    """rows with d_area, d_area_u, fit_width, fit_height (and their _u) of a reach whose widths are linear in height by pieces (slope, intercept) between breaks.

    Between the breaks height and width are corrected for errors in both, along the piece's line and again along that of the corrected height, if heights vary
    enough: their variance (spread) less the error's is twice the error's at least. Sections are integrated from the lowest break up. Beyond the last
    break the section is that of the last piece and the median; below the first a trapezoid of the observed width and the line's. Each step is a column of its own, as
    the steps put into one another would be a very long expression.
    """
    n, c = len(lines), F.col
    a, b = [x for x, _ in lines], [x for _, x in lines]

    def piece(h: Column) -> Column:
        """The piece that holds h; null beyond the breaks."""
        out = F.when((h >= breaks[0]) & (h < breaks[1]), 0)
        for k in range(1, n):
            out = out.when((h >= breaks[k]) & (h < breaks[k + 1]), k)
        return out

    def corrected(slope: Column, intercept: Column) -> tuple[Column, Column]:
        both = width_var + slope * slope * height_var
        off = width - intercept - slope * height
        return height + off * slope * height_var / both, F.sqrt(height_var - F.pow(slope * height_var, 2.0) / both)

    noisy = (spread - height_var) / height_var < 2
    out = rows.withColumns({"_noisy": noisy, "_first": piece(height)})
    out = out.withColumns({"_a": _of_piece(a, c("_first")), "_b": _of_piece(b, c("_first"))})
    h, u = corrected(c("_a"), c("_b"))
    out = out.withColumns({"_h": F.when(c("_noisy"), height).otherwise(h), "_u": F.when(c("_noisy"), height_u).otherwise(u)})
    out = out.withColumn("_moved", piece(c("_h"))).withColumn("_at", F.coalesce("_moved", "_first"))
    out = out.withColumns({"_a": _of_piece(a, c("_at")), "_b": _of_piece(b, c("_at")), "_top": _of_piece(breaks[1:], c("_at"))})
    h, u = corrected(c("_a"), c("_b"))
    again = c("_moved").isNotNull()
    out = out.withColumns({"_hat": F.when(again, h).otherwise(c("_h")), "_hat_u": F.when(again, u).otherwise(c("_u"))})
    whole = lambda k, h: a[k] / 2 * h * h + b[k] * h
    inside: Column = F.lit(0.0)
    for k in range(n):
        inside = inside + F.when(c("_at") >= k, whole(k, F.least(c("_hat"), breaks[k + 1])) - whole(k, breaks[k])).otherwise(0.0)
    mu = F.sqrt(c("_a") / 2) * (c("_hat") - c("_top")) + (c("_a") * c("_top") + c("_b")) / F.nullif(F.sqrt(2 * c("_a")), F.lit(0.0))
    out = out.withColumns({"_inside": inside - median_area, "_mu": mu, "_sigma2": c("_a") / 2 * height_var})
    inside_u = F.when(c("_a") == 0, c("_b") * F.sqrt(height_var)).when(c("_a") > 0, F.sqrt(4 * c("_mu") * c("_mu") * c("_sigma2") + 2 * c("_sigma2") * c("_sigma2")))
    above, within, fitted = height >= breaks[-1], c("_first").isNotNull(), c("_first").isNotNull() & ~c("_noisy")
    outside_u = F.sqrt(height_var * width * width + 2 * width_var * F.pow(height - F.when(above, breaks[-1]).otherwise(breaks[0]), 2.0))
    top_area = whole(n - 1, breaks[-1]) - whole(n - 1, breaks[-2]) + median_area
    below_area = -median_area - (breaks[0] - height) * (width + a[0] * breaks[0] + b[0]) / 2
    out = out.withColumns({
        "d_area": F.when(within, c("_inside")).when(above, top_area).otherwise(below_area), "d_area_u": F.when(within, inside_u).otherwise(outside_u),
        "fit_width": F.when(fitted, c("_a") * c("_hat") + c("_b")).otherwise(width), "fit_width_u": F.when(fitted, c("_hat_u") * c("_a")).otherwise(width_u),
        "fit_height": F.when(within, c("_hat")), "fit_height_u": F.when(within, c("_hat_u")),
    })
    return out.drop("_noisy", "_first", "_a", "_b", "_h", "_u", "_moved", "_at", "_top", "_hat", "_hat_u", "_inside", "_mu", "_sigma2")
