"""Typed products: declared schemas, reading with missing columns, writing with fills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read(spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet") -> DataFrame:
    """The declared columns; those a file lacks are null."""
    have = spark.read.format(file_format).load(path)
    return have.select(*((F.col(f.name) if f.name in have.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def write(df: DataFrame, path: str, schema: StructType, file_format: str = "parquet", mode: str = "errorifexists") -> None:
    """Cast to the declared types; nulls become the field's fill (metadata key fill), NaN too."""
    def column(f):
        c = F.col(f.name)
        c = F.when(F.isnan(c), None).otherwise(c) if f.dataType.typeName() in ("double", "float") else c
        return (F.coalesce(c, F.lit(f.metadata["fill"])) if "fill" in f.metadata else c).cast(f.dataType).alias(f.name)

    df.select(*map(column, schema)).write.format(file_format).mode(mode).save(path)


def point_text(lon, lat):
    """WKT of a point."""
    return F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))
