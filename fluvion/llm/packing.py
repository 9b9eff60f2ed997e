"""Best-fit packing by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, stored
from .tokens import VOCABULARY, encoder

CAPACITY = 1024
END_ID = 2
#: About so many pieces are packed together in one task.
GROUP = 60_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole capacities but for the first."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return [(0, first)] * bool(first) + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of each document's ids and end_id; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py()), end_id).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    out.append((doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECE_SCHEMA)


def sum_of_squares(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Sequences as lists of places in lengths, which are taken longest first.

    Counts of open sequences are held for each gap. Of the gaps that hold a piece it goes into the one after which the sum of the squared
    counts is smallest: filling one of gap g takes 2 count(g) - 1 off and adds 2 count(g - item) + 1 for the new gap, if any
    remains. Ties prefer the smaller gap. A new sequence opens only where no open one holds the piece: the rule for endless
    streams also opens one to keep the counts even for pieces to come, but here all pieces are known and none come.
    """
    count = np.zeros(capacity + 1, np.int64)
    held: list[list[int]] = [[] for _ in range(capacity + 1)]
    out: list[list[int]] = []
    far = np.iinfo(np.int64).max
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        item, gap = lengths[k], capacity
        if item < capacity:
            change = 2 * (count[: capacity - item] - count[item:capacity]) + 2
            change[0] = 1 - 2 * count[item]
            change[count[item:capacity] == 0] = far
            best = int(np.argmin(change))
            if change[best] < far:
                gap = item + best
        if gap == capacity:
            sequence = len(out)
            out.append([k])
        else:
            sequence = held[gap].pop()
            count[gap] -= 1
            out[sequence].append(k)
        if gap > item:
            held[gap - item].append(sequence)
            count[gap - item] += 1
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """Each piece of each document with its sequence and place there.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Pieces are dealt by a hash of their row
    to groups of about group rows, whatever their document or source; a group is packed in one task from
    lengths alone. Null and empty texts are a piece of one id. Rows with equal ids stay apart rows. An empty table
    gives an empty one; other columns of docs are ignored.
    """
    rows = stored(pieces(docs, capacity, vocabulary, end_id), "pack-pieces")
    groups = -(-rows.count() // group) or 1

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row_key", kind="stable").reset_index(drop=True)
        lengths = frame.length.tolist()
        sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
        for s, members in enumerate(sum_of_squares(lengths, capacity)):
            at = 0
            for k in members:
                sequence[k], offset[k] = s, at
                at += lengths[k]
        frame["sequence_id"], frame["offset"] = (int(key[0]) << 32) + sequence, offset
        return frame[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    dealt = numbered(rows).withColumn("pack_group", F.pmod("row_key", F.lit(groups)))
    return dealt.groupBy("pack_group").applyInPandas(run, f"{PIECE_SCHEMA}, sequence_id long, offset long")
