"""Training-order materialisation: a keyed permutation gives every sequence its slot in fixed-stride shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mix, stored
from .tokens import VOCABULARY, encoder

SEQUENCE = 512
STRIDE = 2 * SEQUENCE  # bytes of a record: unsigned 16-bit ids
END_ID = 50256
RECORDS_PER_SHARD = 16_384
KEY = 20_240_229
ROUNDS = 4

SEQUENCES = "doc_id long, piece int, n_tokens int, ids binary"


def sequences(docs: DataFrame, length: int = SEQUENCE, vocabulary: str = VOCABULARY) -> DataFrame:
    """Each document's ids and END_ID, cut into sequences of length ids; the last may be shorter. A null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py()), END_ID).astype("<u2")
                for k, at in enumerate(range(0, len(ids), length)):
                    part = ids[at : at + length]
                    out.append((doc_id, k, len(part), part.tobytes()))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["doc_id", "piece", "n_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, SEQUENCES)


def permute(ordinals: np.ndarray, total: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed bijection of 0 .. total - 1.

    A balanced Feistel network over the smallest even number of bits that hold total; values at or beyond total walk on
    through the network until they are inside. At most three in four values are outside, so walks are short.
    """
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            left, right = right, left ^ (mix(right + k) & low)
        return (left << np.uint64(half)) | right

    x = network(ordinals.astype(np.uint64))
    outside = np.flatnonzero(x >= total)
    while len(outside):
        x[outside] = network(x[outside])
        outside = outside[x[outside] >= total]
    return x.astype(np.int64)


def materialise(docs: DataFrame, key: int = KEY, length: int = SEQUENCE, records_per_shard: int = RECORDS_PER_SHARD, vocabulary: str = VOCABULARY) -> DataFrame:
    """Fixed-stride records in training order.

    Columns: slot, shard, row (the record's place in its shard), doc_id, piece, n_tokens, record (2 * length bytes,
    little-endian unsigned 16-bit ids, filled up with END_ID). Sequences are written once as a table; a sequence's ordinal is
    its place in that table (files by name, rows by position), its slot the keyed permutation of the ordinal.
    Partition s of the result is shard s, sorted by slot, so a plain write leaves one file for each shard.
    Null and empty texts give one sequence of END_ID; rows with equal ids stay apart rows; an empty table gives an empty
    one; other columns of docs are ignored.
    """
    spark = docs.sparkSession
    rows = stored(sequences(docs, length, vocabulary), "order-sequences")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    rows = rows.withColumn("file", name).withColumn("at", F.col("_metadata.row_index"))
    files = stored(rows.groupBy("file").count(), "order-files")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    firsts = files.select("file", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    total = files.agg(F.sum("count")).first()[0] or 0
    shards = max(1, -(-total // records_per_shard))

    @F.pandas_udf("long")
    def slot_of(ordinal: pd.Series) -> pd.Series:
        return pd.Series(permute(ordinal.to_numpy(), total, key))

    # one row for each file of the table, so as many as the write had tasks
    placed = rows.join(F.broadcast(firsts), "file").withColumn("slot", slot_of(F.col("first") + F.col("at")))
    placed = placed.withColumn("shard", (F.col("slot") / records_per_shard).cast("int")).drop("file", "at", "first")
    ordered = placed.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")
    return ordered.select("slot", "shard", (F.col("slot") % records_per_shard).cast("int").alias("row"), "doc_id", "piece", "n_tokens", record(length).alias("record"))


def record(length: int = SEQUENCE) -> Column:
    """ids filled up to the stride with END_ID."""
    end = END_ID.to_bytes(2, "little")
    return F.expr(f"cast(rpad(ids, {2 * length}, X'{end.hex()}') as binary)")


def write_shards(ordered: DataFrame, path: str) -> None:
    """One folder for each shard; records of a shard lie in slot order."""
    ordered.write.partitionBy("shard").parquet(path)


def read_from(spark: SparkSession, path: str, slot: int, records_per_shard: int = RECORDS_PER_SHARD) -> DataFrame:
    """The records from slot on, in order: earlier shards are pruned by folder, earlier records by the pushed-down slot."""
    return spark.read.parquet(path).where((F.col("shard") >= slot // records_per_shard) & (F.col("slot") >= slot)).orderBy("slot")
