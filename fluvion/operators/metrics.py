"""Errors of products against truth, distributions and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import joins

# An error up to the first passes, beyond the second it fails (area %, height cm, slope cm/km).
LIMITS = {"area": (15.0, 30.0), "wse": (10.0, 20.0), "slope": (1.7, 3.4)}


def share(data: Column, truth: Column) -> Column:
    """The error in percent of truth; null where truth is 0."""
    return (data - truth) / F.nullif(truth, F.lit(0.0)) * 100


def verdict(error: Column, metric: str) -> Column:
    """pass, between or fail; null for a null error."""
    good, bad = LIMITS[metric]
    size = F.abs(error)
    return F.when(size <= good, "pass").when(size <= bad, "between").when(size > bad, "fail")


def all_or_null(*values: Column) -> list[Column]:
    """The values, all null where any is."""
    known = values[0].isNotNull()
    for v in values[1:]:
        known &= v.isNotNull()
    return [F.when(known, v) for v in values]


def spread(value: Column, shares: tuple[float, ...] = (0.16, 0.5, 0.84)) -> dict[str, Column]:
    """Exact percentiles as aggregates, named p16 and so on."""
    return {f"p{round(s * 100)}": F.percentile(value, F.lit(s)) for s in shares}


def bin_of(value: Column, low: float, high: float, bins: int) -> Column:
    """1 to bins for values from low to high, the upper end in the last bin; null outside."""
    at = F.floor((value - low) / ((high - low) / bins)).cast("int") + 1
    return F.when((value >= low) & (value <= high), F.least(at, F.lit(bins)))


def line_error(rows: DataFrame, key: list[str], x: str, y: str) -> DataFrame:
    """key and error: the largest distance of y from its key's fitted line, in units of y times 100."""
    fit = rows.groupBy(*key).agg(F.regr_slope(y, x).alias("_a"), F.regr_intercept(y, x).alias("_b"))
    off = F.abs(F.col(y) - F.col("_a") * F.col(x) - F.col("_b"))
    return rows.join(fit, key).groupBy(*key).agg((F.max(off) * 100).alias("error"))


def overlay(data: DataFrame, truth: DataFrame, cell: list[str], klass: str) -> DataFrame:
    """Both on one grid of cells: hit where both have the cell, miss where only truth has it, false where only data has it."""
    d, t = data.select(*cell, F.col(klass).alias("data")), truth.select(*cell, F.col(klass).alias("truth"))
    kind = F.when(F.col("data").isNull(), "miss").when(F.col("truth").isNull(), "false").otherwise("hit")
    return d.join(t, cell, "full").select(*cell, "data", "truth", kind.alias("kind"))


def median_filter(pixels: DataFrame, key: list[str], i: str, j: str, value: str, reach: int = 5) -> DataFrame:
    """Each cell's median over the cells up to reach away in both directions; cells without a pixel don't count.

    Each pixel is given to its (2 reach + 1)^2 neighbours, so it is an aggregate on cells, not a range join.
    """
    steps = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in range(-reach, reach + 1) for b in range(-reach, reach + 1)]
    given = pixels.select(*key, i, j, value, F.explode(F.array(*steps)).alias("_s"))
    given = given.select(*key, (F.col(i) + F.col("_s.a")).alias(i), (F.col(j) + F.col("_s.b")).alias(j), value, ((F.col("_s.a") == 0) & (F.col("_s.b") == 0)).alias("_own"))
    return given.groupBy(*key, i, j).agg(F.median(value).alias(value), F.bool_or("_own").alias("_own")).where("_own").drop("_own")


def record_number(points: DataFrame, records: DataFrame, key: list[str], time: str, number: str, stretch: float) -> DataFrame:
    """points with number: the nearest whole record number at their time, between the records before and after it.

    Beyond the first or last record the number is null. Times are merged by stretches of so long (see joins.bracketed).
    """
    met = joins.bracketed(points, records.withColumn("_number", F.col(number).cast("double")), key, time, time, "_number", stretch)
    part = F.coalesce((F.col("_at") - F.col("_lo.at")) / F.nullif(F.col("_hi.at") - F.col("_lo.at"), F.lit(0.0)), F.lit(0.0))
    whole = F.rint(F.col("_lo.n") + part * (F.col("_hi.n") - F.col("_lo.n"))).cast("long")
    return met.select(*points.columns, F.when(F.col("_hi").isNotNull(), whole).alias(number))


def ranked_share(rows: DataFrame, key: list[str], value: str, order: list[str], width: float) -> DataFrame:
    """rows with share: k / n of the k-th of the n rows of a key by value, then order.

    Rows are ranked within bins of value; a window over the bins' counts, one row a bin, adds the rows of the bins below. So
    a task holds one bin, not a key's rows.
    """
    binned = rows.withColumn("_bin", F.floor(F.col(value) / width))
    w = Window.partitionBy(*key).orderBy("_bin")
    counts = binned.groupBy(*key, "_bin").agg(F.count("*").alias("_c"))
    counts = counts.withColumn("_below", F.sum("_c").over(w) - F.col("_c")).withColumn("_n", F.sum("_c").over(Window.partitionBy(*key)))
    placed = binned.withColumn("_k", F.row_number().over(Window.partitionBy(*key, "_bin").orderBy(value, *order)))
    return placed.join(counts, [*key, "_bin"]).select(*rows.columns, ((F.col("_k") + F.col("_below")) / F.col("_n")).alias("share"))


# Bounds within which the science requirements hold (m, m2, shares); reach flags above the last are bad.
BOUNDS = {"min_xtrk": 10_000.0, "max_xtrk": 60_000.0, "min_width": 100.0, "min_area": 800_000.0, "min_length": 8000.0, "min_obs_frac": 0.5, "max_dark_frac": 1.0, "min_truth_obs_frac": 1.0, "min_xtrk_ratio": 0.5, "max_flag": 33_554_432}


def science(rows: DataFrame, bounds: dict[str, float] = BOUNDS) -> DataFrame:
    """rows with in_science: truth and data of a reach within all bounds; null values are outside.

    Columns xtrk, width, area, length, truth_obs_frac, dark_frac of truth; obs_frac, flag of data; xtrk_ratio of the reach's nodes.
    """
    b, c = bounds, F.col
    kept = [
        F.abs("xtrk") > b["min_xtrk"], F.abs("xtrk") < b["max_xtrk"], c("width") > b["min_width"], c("area") > b["min_area"], c("length") >= b["min_length"], c("truth_obs_frac") >= b["min_truth_obs_frac"],
        c("dark_frac") <= b["max_dark_frac"], c("flag") <= b["max_flag"], c("xtrk_ratio") >= b["min_xtrk_ratio"], c("obs_frac") >= b["min_obs_frac"],
    ]
    whole = kept[0]
    for k in kept[1:]:
        whole = whole & k
    return rows.withColumn("in_science", F.coalesce(whole, F.lit(False)))


def outside_counts(rows: DataFrame, bounds: dict[str, float] = BOUNDS) -> DataFrame:
    """One row: how many reaches there are and how many each bound leaves out, by the columns of science() and data_dark_frac."""
    b, c, n = bounds, F.col, F.count_if
    return rows.agg(
        F.count("*").alias("n"), n((F.abs("xtrk") < b["min_xtrk"]) | (F.abs("xtrk") > b["max_xtrk"])).alias("bad_xtrk"), n(c("width") < b["min_width"]).alias("bad_width"), n(c("area") < b["min_area"]).alias("bad_area"),
        n(c("length") < b["min_length"]).alias("bad_length"), n(c("obs_frac") < b["min_obs_frac"]).alias("bad_obs_frac"), n(c("data_dark_frac") >= b["max_dark_frac"]).alias("bad_dark_frac"),
        n(c("flag") > b["max_flag"]).alias("bad_flag"), n(c("xtrk_ratio") < b["min_xtrk_ratio"]).alias("bad_xtrk_ratio"),
    )
