"""Field measurements and rasters: pressure transducers, drifters, float grids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo

EPOCH = "2000-01-01 00:00:00"


def _seconds(text: F.Column, pattern: str) -> F.Column:
    """Seconds since 2000 of a text without a zone."""
    return (F.unix_micros(F.try_to_timestamp(text, F.lit(pattern))) - F.unix_micros(F.to_timestamp(F.lit(EPOCH)))) / 1e6


def transducers(spark: SparkSession, path: str, zone: int = 10) -> DataFrame:
    """transducer, time, wse, longitude, latitude, river_mile of one text file.

    Lines 1 to 4: ids (after three words), northings, eastings and miles (after two words); line 6 names the columns, the rest are
    tab-separated, blanks are null. The header is a few lines and is read first; the body is split by Spark.
    """
    head = [x.value.split() for x in spark.read.text(path).limit(6).collect()]
    ids, north, east, mile, names = head[0][3:], head[1][2:], head[2][2:], head[3][2:], head[5]
    places = spark.createDataFrame([(i, float(n), float(e), float(m)) for i, n, e, m in zip(ids, north, east, mile, strict=True)], "transducer string, north double, east double, river_mile double")
    lon, lat = geo.utm_inverse(F.col("east"), F.col("north"), zone)
    places = places.select("transducer", "river_mile", lon.alias("longitude"), lat.alias("latitude"))
    part = F.split("value", "\t")
    body = spark.read.text(path).where(F.col("value").rlike(r"^\d{8}\t"))
    of = lambda name: F.try_element_at(part, F.lit(names.index(name) + 1))
    values = F.explode(F.array(*(F.struct(F.lit(i).alias("transducer"), F.trim(of(i)).try_cast("double").alias("wse")) for i in ids)))
    rows = body.select(_seconds(F.concat(of("YYYYMMDD"), F.lpad(F.trim(of("HHMMSS")), 6, "0")), "yyyyMMddHHmmss").alias("time"), values.alias("v")).select("time", "v.*")
    return rows.join(F.broadcast(places), "transducer")  # one row a transducer of one header line


def drifters(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Text separated by white space with the named columns, all double; values that aren't numbers are null."""
    part = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.trim("value") != "").select(*(F.try_element_at(part, F.lit(k + 1)).try_cast("double").alias(n) for k, n in enumerate(names)))


def drifter_pixels(rows: DataFrame, formal_error: str, limit: float = 0.25) -> DataFrame:
    """Good rows are of class 1, others of class 0."""
    return rows.withColumn("classification", F.when(F.col(formal_error) < limit, 1).otherwise(0))


def grid_header(text: str) -> dict:
    """Of a grid's control text: undef, and the axes as (number, first, step)."""
    out: dict = {}
    for words in (line.split() for line in text.splitlines()):
        if words and words[0].lower() in ("xdef", "ydef"):
            out[words[0].lower()[0]] = (int(words[1]), float(words[3]), float(words[4]))
        elif words and words[0].lower() == "undef":
            out["undef"] = float(words[1])
        elif words and words[0].lower() == "options":
            out["reverse"] = "yrev" in words
    return out


def grid(spark: SparkSession, path: str, header: dict) -> DataFrame:
    """longitude, latitude, value of the cells of little-endian float tiles that hold a value; a file is a tile of fixed size.

    With yrev rows run from the last latitude to the first.
    """
    (nx, x0, dx), (ny, y0, dy), undef, reverse = header["x"], header["y"], header.get("undef"), header.get("reverse", False)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame.content:
                values = np.frombuffer(content, "<f4").reshape(ny, nx)
                for i in range(ny):
                    j = np.flatnonzero(values[i] != undef)
                    lat = y0 + dy * (ny - 1 - i if reverse else i)
                    yield pd.DataFrame({"longitude": x0 + dx * j, "latitude": lat, "value": values[i][j].astype(float)})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "longitude double, latitude double, value double")
