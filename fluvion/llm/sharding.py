"""A two-pass external shuffle into shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import stored

SHARDS = 24
SEED = 7
#: Bytes of text that one bucket holds on average; a task shuffles one bucket in memory.
BUCKET_BYTES = 24 << 20


def external_shuffle(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of docs in a uniformly random order, cut into shards whose row counts differ by one at most.

    Pass one scatters rows into buckets by a seeded hash of id and text. Pass two brings the rows of a bucket into a fixed
    order and shuffles them (Fisher-Yates, as NumPy's permutation does it), seeded by seed and bucket. A bucket's first
    place in the whole order is the sum of the counts of those before it; a shard is a stretch of that order.
    Adds shard, slot (gapless from 0 in each shard) and bucket; columns of docs of these names are replaced. Null ids and
    texts are scattered like others; rows equal in id and text lie in one bucket, in any order among themselves.
    """
    docs = docs.drop("shard", "slot", "bucket")
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    weight = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    buckets = max(1, -(-weight // bucket_bytes))
    dealt = docs.withColumn("bucket", F.pmod(key, F.lit(buckets)).cast("int")).withColumn("__key", key)
    counts = stored(dealt.groupBy("bucket").count(), "shuffle-counts")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    places = counts.withColumn("__first", F.coalesce(F.sum("count").over(before), F.lit(0))).select("bucket", "__first").withColumn("__total", F.lit(counts.agg(F.sum("count")).first()[0] or 0).cast("long"))
    columns = docs.columns
    schema = StructType([*docs.schema.fields, StructField("bucket", LongType()), StructField("__place", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if whole is None or not len(whole):
            return
        buckets_here = whole["bucket"].to_numpy()
        for b in np.unique(buckets_here):
            rows = whole.filter(pc.equal(whole["bucket"], int(b)))
            rows = rows.take(pc.sort_indices(rows, [("__key", "ascending"), ("doc_id", "ascending")]))
            place = np.random.default_rng([seed, int(b)]).permutation(len(rows))  # Fisher-Yates
            rows = rows.take(pa.array(np.argsort(place)))
            out = rows.select(columns).append_column("bucket", rows["bucket"].cast(pa.int64())).append_column("__place", pa.array(np.arange(len(rows)), pa.int64()))
            yield from out.to_batches(max_chunksize=2000)

    scattered = dealt.repartitionById(buckets, F.col("bucket")).mapInArrow(run, schema)
    at = F.col("__first") + F.col("__place")
    joined = scattered.join(F.broadcast(places) if buckets <= 100_000 else places, "bucket").withColumn("__at", at)
    # shard s holds the places from ceil(s * total / shards) on
    shard = F.expr(f"cast(__at * {shards} div __total as int)")
    joined = joined.withColumn("shard", shard)
    first = F.expr(f"(cast(shard as long) * __total + {shards - 1}) div {shards}")
    return joined.withColumn("slot", F.col("__at") - first).drop("__first", "__total", "__place", "__at")


def write_shards(shuffled: DataFrame, path: str) -> None:
    """The shuffled rows as Parquet, a folder for each shard; rows of a file are in the shuffled order."""
    shuffled.write.partitionBy("shard").parquet(path)
