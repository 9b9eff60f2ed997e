"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="fluvion-")


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local session without the setting gets a temporary folder, a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return base or _own_folder()


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table of its own: iterations don't lengthen the plan and a lost executor costs one step. Deleted when the session ends."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
