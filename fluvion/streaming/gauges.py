"""Gauge and drifter series as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed(series: DataFrame, time: str, key: str, value: str, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Mean, population deviation and count for each key and window; works on streams (with the watermark late) and tables alike."""
    rows = series.withWatermark(time, late) if series.isStreaming else series
    g = rows.groupBy(F.window(time, width).alias("w"), key)
    return g.agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count(value).alias("n")).select(key, F.col("w.start").alias("start"), "mean", "std", "n")
