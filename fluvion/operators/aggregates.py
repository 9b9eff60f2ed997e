"""Aggregates over the pixels of a node, as Column builders: each is one column of a single groupBy().agg()."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quality import NODE_BITS

# Pixel classes that count as interior water, water and land edge, and dark water.
INTERIOR, WATER_EDGE, LAND_EDGE, DARK = (4, 6, 7), (3,), (2,), (5, 22, 23, 24)


def only(value: Column, mask: Column | None) -> Column:
    return value if mask is None else F.when(mask, value)


def count(mask: Column) -> Column:
    return F.count_if(mask)


def total(value: Column, mask: Column | None = None) -> Column:
    return F.coalesce(F.sum(only(value, mask)), F.lit(0.0))


def percentile(value: Column, share: float, mask: Column | None = None) -> Column:
    """Exact, with linear interpolation."""
    return F.percentile(only(value, mask), F.lit(share))


def circular_median(degrees: Column, mask: Column | None = None) -> Column:
    a = F.radians(only(degrees, mask))
    return F.degrees(F.atan2(F.median(F.sin(a)), F.median(F.cos(a))))


STATS = {
    "mean": lambda v, m=None: F.avg(only(v, m)),
    "median": lambda v, m=None: F.median(only(v, m)),
    "std": lambda v, m=None: F.stddev_pop(only(v, m)),
    "stderr": lambda v, m=None: F.stddev_pop(only(v, m)) / F.sqrt(F.count(only(v, m))),
    "min": lambda v, m=None: F.min(only(v, m)),
    "max": lambda v, m=None: F.max(only(v, m)),
    "range": lambda v, m=None: F.max(only(v, m)) - F.min(only(v, m)),
    "sum": total,
    "count": lambda v, m=None: F.count(only(v, m)),
    "sincos_median": circular_median,
}


def weighted_mean(value: Column, sigma: Column, mask: Column | None = None) -> Column:
    """Weights are 1 / sigma squared."""
    w = 1 / (sigma * sigma)
    return F.sum(only(value * w, mask)) / F.sum(only(w, mask))


def weighted_std(value: Column, mean: Column, sigma: Column, medium_looks: Column, rare_looks: Column, mask: Column | None = None) -> Column:
    """Spread about a mean that a window has given, for the number of independent looks."""
    w = 1 / (sigma * sigma)
    spread = F.sqrt(F.sum(only((value - mean) * (value - mean) * w, mask)) / F.sum(only(w, mask)))
    return spread * F.sqrt(F.avg(only(medium_looks / rare_looks, mask)) / F.count(only(value, mask)))


def area(pixel_area: Column, water_frac: Column, klass: Column, mask: Column | None = None, interior=INTERIOR, edges=(*WATER_EDGE, *LAND_EDGE), dark=DARK) -> Column:
    """Composite area: interior and dark pixels whole, edge pixels by their water fraction, clipped to -3 .. 3."""
    frac = F.greatest(F.least(water_frac, F.lit(3.0)), F.lit(-3.0))
    return total(F.when(klass.isin(*interior, *dark), pixel_area).when(klass.isin(*edges), pixel_area * frac).otherwise(0.0), mask)


def detected_area(pixel_area: Column, water_frac: Column, klass: Column, mask: Column | None = None) -> Column:
    return area(pixel_area, water_frac, klass, mask, dark=())


def area_rate_std(pixel_area: Column, false_rate: Column, miss_rate: Column, klass: Column, mask: Column | None = None, p_class: float = 0.9, p_water: float = 0.5) -> Column:
    """Standard deviation of a summed area whose pixels are detected at given rates."""
    p = F.when(klass.isin(*INTERIOR), p_class * (1 - miss_rate) + (1 - p_class) * false_rate).otherwise(p_water * (1 - miss_rate) + (1 - p_water) * false_rate)
    return F.sqrt(total(pixel_area * pixel_area * p * (1 - p), mask))


def coherence(re: Column, im: Column, power_a: Column, power_b: Column, weight: Column) -> Column:
    r, i = F.sum(re * weight), F.sum(im * weight)
    return F.sqrt(r * r + i * i) / F.sqrt(F.sum(power_a * weight) * F.sum(power_b * weight))


def phase_std(gamma: Column, looks: Column, floor: float = 1e-10) -> Column:
    return F.sqrt(F.greatest((0.5 / looks) * (1 - gamma * gamma) / (gamma * gamma), F.lit(floor)))


def multilook(re: Column, im: Column, power_a: Column, power_b: Column, looks: Column, weight: Column, sensitivity: dict[str, Column], floor: float = 1e-10) -> dict[str, Column]:
    """Aggregates: coherence, and <name>_u for each sensitivity to phase: the phase's deviation projected by its weighted mean.

    Products are averaged with the weights; the number of looks is their mean times the number of pixels. Weights may be of any scale: the ratios don't depend on it.
    """
    mean = lambda v: F.avg(v * weight)
    gamma = F.sqrt(mean(re) * mean(re) + mean(im) * mean(im)) / F.sqrt(mean(power_a) * mean(power_b))
    spread = phase_std(gamma, F.avg(looks) * F.count(weight), floor)
    return {"coherence": gamma} | {f"{n}_u": spread * F.abs(mean(d * d) / mean(d)) for n, d in sensitivity.items()}


# Rates at which pixels are classified rightly, hold water a priori, and are truly detected; metres of height error of the prior elevation.
P_CLASS, P_WATER, P_TRUE, DEM_ERROR = 0.9, 0.5, 0.5, 10.0


def area_uncertainty(
    pixel_area: Column, water_frac: Column, frac_std: Column, area_per_height: Column, false_rate: Column, miss_rate: Column, klass: Column, mask: Column | None = None,
    interior=INTERIOR, edges=(*WATER_EDGE, *LAND_EDGE), p_class: float = P_CLASS, p_water: float = P_WATER, p_true: float = P_TRUE, dem_error: float = DEM_ERROR,
) -> dict[str, Column]:
    """Aggregates: the deviations (m2) of a node's area by detected water, by water fraction, and composite.

    Each is the root of a pixel-size term (edges only), a term of the prior elevation, a random term of the rates of classification and a
    bias term, over the edge and interior pixels; dark water counts for none. The composite mixes detection and fraction by the share of edge pixels, for
    which, as for its bias, all pixels count, whatever mask. A node without a pixel in mask has no deviation: null, not 0.
    """
    total = lambda v, m=None: F.sum(only(v, m))
    edge, used = (F.coalesce(klass.isin(*k), F.lit(False)).cast("double") for k in (edges, (*edges, *interior)))
    wrong = 1 - p_class
    p_found = p_class * p_true + wrong * (1 - p_true)
    bias_found = wrong * (1 - p_true) - wrong * p_found
    var_found = wrong * (1 - p_true) + wrong * p_found
    p_detect = (1 - miss_rate) * p_water + false_rate * (1 - p_water)
    var_detect = false_rate * (1 - p_water) + miss_rate * p_water
    var_both = p_found * var_detect + p_water * var_found - 2 * miss_rate * p_water * wrong * (1 - p_true)
    bias_detect = (false_rate * (1 - p_water) - miss_rate * p_water) * p_true + p_water * bias_found
    elevation = F.pow(area_per_height * dem_error * pixel_area, 2.0)
    fraction2 = water_frac * water_frac
    square = pixel_area * pixel_area
    size = total(square / 12 * edge * p_true, mask)
    dem_detect, dem_frac = total(elevation * p_detect * p_found * used, mask), total(elevation * (frac_std * frac_std + fraction2) * p_found * used, mask)
    rate_detect, rate_frac = total(square * var_both * used, mask), total(square * (frac_std * frac_std * p_found + fraction2 * var_found) * used, mask)
    b_detect, b_frac = pixel_area * bias_detect, pixel_area * water_frac * bias_found

    def bias(b: Column, keep: Column, mask: Column | None) -> Column:
        return F.pow(total(b * keep, mask), 2.0) - total(b * b * keep, mask)

    share = F.least(F.coalesce(F.sum(edge) / F.nullif(F.sum(used), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    # (sum of mixed biases)^2 less the sum of their squares, expanded by the share, which is itself an aggregate
    s1, s2 = total(b_detect), total(b_frac)
    q11, q12, q22 = total(b_detect * b_detect), total(b_detect * b_frac), total(b_frac * b_frac)
    mixed = F.pow((1 - share) * s1 + share * s2, 2.0) - ((1 - share) * (1 - share) * q11 + 2 * share * (1 - share) * q12 + share * share * q22)
    return {
        "detected": F.sqrt(size + dem_detect + rate_detect + bias(b_detect, used, mask)),
        "fraction": F.sqrt(size + dem_frac + rate_frac + bias(b_frac, used, mask)),
        "composite": F.sqrt(0.1 * size + rate_frac * share + (1 - share) * rate_detect + dem_frac * share + (1 - share) * dem_detect + mixed),
    }


def widths(across: Column, pixel_area: Column, length: Column) -> dict[str, Column]:
    """A node's width three ways: the extent across, that of an even spread of the same deviation, the area over the length."""
    return {"extent": F.max(across) - F.min(across), "spread": F.sqrt(F.lit(12.0)) * F.stddev_pop(across), "by_area": total(pixel_area) / F.first(length)}


def populated(rows: DataFrame, prior: DataFrame, key: list[str], least: int) -> DataFrame:
    """Every prior node with its number of rows (0 under least) and whether that makes it populated."""
    n = rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return prior.join(n, key, "left").select(*key, F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.col("n").isNotNull().alias("populated"))


def usable(rows: DataFrame, needed: list[str], unwanted: Column | None = None) -> DataFrame:
    """Rows that have all the needed values and, if told, are not unwanted."""
    kept = rows.dropna(subset=needed)
    return kept if unwanted is None else kept.where(~F.coalesce(unwanted, F.lit(False)))


def in_swath(xtrack: Column, near: float = 10_000.0, far: float = 60_000.0) -> Column:
    """An aggregate: the share of rows seen between near and far range."""
    return F.avg(((F.abs(xtrack) > near) & (F.abs(xtrack) < far)).cast("double"))


def without_lakes(rows: DataFrame, lakes: DataFrame, key: list[str], values: list[str], flag: str, summary: str) -> DataFrame:
    """rows whose values are null where lakes (key, lake) says so; there the flag gets the lake bit and the summary is bad."""
    lake = F.coalesce("lake", F.lit(False))
    out = rows.join(lakes, key, "left").withColumns({v: F.when(~lake, F.col(v)) for v in values})
    bit = F.lit(1 << NODE_BITS["lake"]).cast("long")
    return out.withColumn(flag, F.when(lake, F.col(flag).bitwiseOR(bit)).otherwise(F.col(flag))).withColumn(summary, F.when(lake, 3).otherwise(F.col(summary))).select(*rows.columns)


def line(x: Column, y: Column, w: Column | None = None) -> tuple[Column, Column]:
    """(slope, intercept) of a line, unweighted ones by the built-in regression, which centres; weighted ones from sums: centre large x first, or use fits.weighted_line."""
    if w is None:
        return F.regr_slope(y, x), F.regr_intercept(y, x)
    ok = x.isNotNull() & y.isNotNull() & w.isNotNull()
    s, sx, sy, sxx, sxy = (F.sum(F.when(ok, v)) for v in (w, w * x, w * y, w * x * x, w * x * y))
    slope = (s * sxy - sx * sy) / F.nullif(s * sxx - sx * sx, F.lit(0.0))
    return slope, (sy - slope * sx) / s
