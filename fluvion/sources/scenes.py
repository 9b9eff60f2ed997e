"""Many scenes as one table: files chosen by their boxes, unequal schemas merged, ragged arrays padded, bad scenes put aside."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions import geo


def named_box(name: Column, dlon: float = 1.0, dlat: float = 1.0) -> dict[str, Column]:
    """x0, y0, x1, y1 of a tile whose file name begins with its south-west corner: e or w and three digits, n or s and two."""
    part = lambda at, n: F.substring(name, at, n)
    lon = part(2, 3).try_cast("double") * F.when(F.lower(part(1, 1)) == "w", -1).otherwise(1)
    lat = part(6, 2).try_cast("double") * F.when(F.lower(part(5, 1)) == "s", -1).otherwise(1)
    return {"x0": lon, "y0": lat, "x1": lon + dlon, "y1": lat + dlat}


def coverage(files: DataFrame, name: str = "name", dlon: float = 1.0, dlat: float = 1.0) -> DataFrame:
    """files with the box told by their names and its polygon as text (from the south-east corner round); both null for other names."""
    out = files.withColumns(named_box(F.col(name), dlon, dlat))
    corner = lambda x, y: F.concat_ws(" ", *(F.format_string("%.6f", F.col(k)) for k in (x, y)))
    ring = F.concat_ws(", ", corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"), corner("x1", "y0"))
    return out.withColumn("polygon", F.when(F.col("x0").isNotNull() & F.col("y0").isNotNull(), F.format_string("POLYGON ((%s))", ring)))


def files_of(spark: SparkSession, folder: str) -> DataFrame:
    """path and name of the files below folder. Their contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    return files.withColumn("name", F.element_at(F.split("path", "/"), -1))


def overlapping(boxes: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Boxes that have an inside in common with one box; longitudes are counted from its west edge, so the antimeridian is no border."""
    east, west = geo.wrap(F.col("x1") - x0), geo.wrap(F.col("x0") - x0)
    width = (x1 - x0 + 180) % 360 - 180
    return boxes.where((F.lit(y0) < F.col("y1")) & (F.lit(y1) > F.col("y0")) & (east > 0) & (west < width))


def read_overlapping(spark: SparkSession, catalogue: DataFrame, box: tuple[float, float, float, float], format: str = "parquet") -> DataFrame | None:
    """The rows of the files of catalogue (path and boxes) that overlap box; the other files are never opened. None if there is none.

    Only the paths of files that match come to the driver, as in any scan of a list of files.
    """
    paths = [r.path for r in overlapping(catalogue, *box).select("path").collect()]
    return spark.read.format(format).option("mergeSchema", "true").load(paths) if paths else None


def merged(scenes: list[DataFrame]) -> DataFrame:
    """One table of all scenes; columns that a scene lacks are null there."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scenes)


def padded(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """rows with arrays filled up with nulls at the end, to the greatest length of the column; null arrays become arrays of nulls."""
    columns = columns or [f.name for f in rows.schema.fields if isinstance(f.dataType, ArrayType)]
    longest = rows.agg(*(F.coalesce(F.max(F.size(c)), F.lit(0)).alias(c) for c in columns)).first()

    def filled(c: str) -> Column:
        kind = rows.schema[c].dataType.elementType
        nothing = F.lit(None).cast(kind)
        have = F.coalesce(F.col(c), F.array().cast(ArrayType(kind)))
        return F.concat(have, F.array_repeat(nothing, F.greatest(F.lit(longest[c]) - F.size(have), F.lit(0))))

    return rows.withColumns({c: filled(c) for c in columns})


def put_aside(rows: DataFrame, scene: str, reasons: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows of good scenes, bad scenes with their first reason and number of rows). reasons: aggregates over a scene that are true if it is bad."""
    told = F.coalesce(*(F.when(test, F.lit(name)) for name, test in reasons.items()))
    found = rows.groupBy(scene).agg(told.alias("reason"), F.count("*").alias("n")).where("reason is not null")
    bad = found.select(F.col(scene).alias("_bad"))
    return rows.join(bad, F.col(scene).eqNullSafe(F.col("_bad")), "left_anti"), found
