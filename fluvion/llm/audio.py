"""Chroma fingerprints of recordings and their alignment."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

RATE, FRAME, HOP = 2000, 256, 128
#: Frames that one code sees.
SPAN = 16
#: Pitches of equal temperament that chroma folds: from A2 to A6.
LOWEST, HIGHEST = 110.0, 1760.0
QUERY_STEP = 50
#: Semitones of the eight notes.
SCALE = np.array([0, 2, 3, 5, 7, 8, 10, 11])
LEAST_OVERLAP, MOST_ERRORS = 32, 0.2
#: Codes of one block of recordings that are compared together.
BLOCK = 1 << 16


def filters() -> list[tuple[int, int, int, int, int]]:
    """(kind, pitch class, height, frame, width) of 16 filters, by rule: kinds in turn, places spread by steps that share no factor with the sides."""
    return [(k % 6, 5 * k % 9, 3 + k % 2 * 3 if 5 * k % 9 <= 6 else 3, 3 * k % 7, 6 + k % 4) for k in range(16)]


def chroma(samples: np.ndarray, rate: int) -> np.ndarray:
    """Frames by 12: the share of each pitch class, from Hann-windowed spectra. A frame and a hop last as long at every rate as FRAME and HOP samples at RATE."""
    size = max(1, round(FRAME * rate / RATE))
    n = int((len(samples) - size) * RATE / (HOP * rate)) + 1 if rate > 0 and len(samples) >= size else 0
    frequency = np.arange(size // 2 + 1) * (RATE / FRAME)
    heard = (frequency >= LOWEST) & (frequency <= min(HIGHEST, rate / 2))
    pitch = np.round(12 * np.log2(frequency[heard] / 440)).astype(int) % 12
    out = np.zeros((n, 12))
    for i in range(0, n, 256):  # so many frames at once, for long recordings
        at = np.floor(np.arange(i, min(i + 256, n)) * (HOP * rate / RATE)).astype(int)[:, None] + np.arange(size)
        power = np.abs(np.fft.rfft(samples[at] * np.hanning(size), axis=1)) ** 2
        out[i : i + 256] = np.stack([power[:, heard][:, pitch == c].sum(axis=1) for c in range(12)], axis=1)
    return out / (out.sum(axis=1, keepdims=True) + 1e-9)


def codes(frames: np.ndarray) -> np.ndarray:
    """A 32-bit code for every SPAN frames: 16 filters of two bits each, over the integral image of the frames."""
    n = len(frames) - SPAN + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    image = np.zeros((len(frames) + 1, 13))
    image[1:, 1:] = frames.cumsum(axis=0).cumsum(axis=1)
    t = np.arange(n)

    def area(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        return image[t + t1, p1] - image[t + t0, p1] - image[t + t1, p0] + image[t + t0, p0]

    out = np.zeros(n, np.uint32)
    for kind, p, h, at, w in filters():
        whole = area(at, at + w, p, p + h)
        if kind == 0:
            a, b = whole, area(0, SPAN, 0, 12) * (w * h / (12 * SPAN))
        elif kind == 1:
            a = area(at, at + w, p, p + h // 2) + 0 * whole
            b = whole - a
        elif kind == 2:
            a = area(at, at + w // 2, p, p + h)
            b = whole - a
        elif kind == 3:
            a = area(at, at + w // 2, p, p + h // 2) + area(at + w // 2, at + w, p + h // 2, p + h)
            b = whole - a
        elif kind == 4:
            a = area(at, at + w, p + h // 3, p + h - h // 3)
            b = whole - a
        else:
            a = area(at + w // 3, at + w - w // 3, p, p + h)
            b = whole - a
        level = np.digitize(np.log((a + 0.05) / (b + 0.05)), (-0.7, 0.0, 0.7))
        out = (out << np.uint32(2)) | np.array([0, 1, 3, 2], np.uint32)[level]  # neighbours differ in one bit
    return out


def decode(media: bytes | None) -> tuple[np.ndarray, int]:
    """Mono samples and the rate of a WAV file; none if it is null or can't be read."""
    try:
        with wave.open(io.BytesIO(media or b"")) as f:
            width, channels, data = f.getsampwidth(), f.getnchannels(), f.readframes(f.getnframes())
            if width == 3:  # as the upper bytes of 32 bits
                wide = np.zeros((len(data) // 3, 4), np.uint8)
                wide[:, 1:] = np.frombuffer(data, np.uint8).reshape(-1, 3)
                width, data = 4, wide.tobytes()
            kind = {1: np.uint8, 2: np.int16, 4: np.int32}[width]
            x = np.frombuffer(data, kind).astype(float).reshape(-1, channels).mean(axis=1)
            return x - (128 if width == 1 else 0), f.getframerate()
    except (wave.Error, EOFError, KeyError, ValueError):
        return np.zeros(0), RATE


def fingerprints(recordings: DataFrame, media: str = "media") -> DataFrame:
    """rec_id and codes (array of int) of every recording; null or broken media give no codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [codes(chroma(*decode(m.as_py()))).view(np.int32) for m in batch.column(1)]
            yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(found, pa.list_(pa.int32()))], ["rec_id", "codes"])

    return recordings.select("rec_id", media).mapInArrow(run, "rec_id long, codes array<int>")


def least_errors(a: np.ndarray, b: np.ndarray, most_errors: float = MOST_ERRORS) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a against rows of b, at every offset: the least share of different bits (2 where no offset is within most_errors) and its offset, the least on ties.

    The offset is by how many places a lies ahead; at least LEAST_OVERLAP codes overlap, or all of the shorter one.
    With bits as -1 and 1, d different bits are a squared distance of 4 d, and sums of three codes in a row, over the root of three,
    lie no farther apart: where these are too far already, the bits need no counting. So the screen loses no pair.
    """
    share, where = np.full((len(a), len(b)), 2.0), np.zeros((len(a), len(b)), np.int32)
    la, lb = a.shape[1], b.shape[1]
    least = min(LEAST_OVERLAP, la, lb)
    sums = []
    for z in (a, b):
        bits = np.unpackbits(np.ascontiguousarray(z).view(np.uint8), axis=1).reshape(*z.shape, 32).astype(np.float32) * 2 - 1
        total = np.zeros((len(z), max(z.shape[1] - 2, 0), 32), np.float32)
        for i in range(3):
            total += bits[:, i : i + total.shape[1]]
        sums.append(total)
    for offset in range(least - lb, la - least + 1):
        start, end = max(0, offset), min(la, lb + offset)
        n = end - start
        x, y = (t[:, s : s + n // 3 * 3 : 3].reshape(len(t), -1) for t, s in zip(sums, (start, start - offset), strict=True))
        size = [(z * z).sum(axis=1, keepdims=True) for z in (x, y)]
        x, y = np.hstack((-2 * x, np.ones_like(size[0]), size[0])), np.hstack((y, size[1], np.ones_like(size[1])))
        most = 12 * most_errors * 32 * n * 1.0001 + 1
        for i in range(0, len(a), 64):
            row, column = np.divmod(np.flatnonzero(x[i : i + 64] @ y.T <= most), len(b))
            row += i
            errors = np.bitwise_count(a[row, start:end] ^ b[column, start - offset : end - offset]).sum(axis=1, dtype=np.int64) / (32 * n)
            better = (errors <= most_errors) & (errors < share[row, column])
            share[row[better], column[better]], where[row[better], column[better]] = errors[better], offset
    return share, where


def _by_length(side: pa.StructArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in side and codes, as a matrix, of the recordings of each length."""
    codes = side.field("codes")
    flat, start = codes.flatten().to_numpy().view(np.uint32), np.concatenate(([0], np.cumsum(codes.value_lengths().to_numpy())))
    length = np.diff(start)
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        yield at, flat[start[at][:, None] + np.arange(n)]


def _blocks(rows: DataFrame, name: str, *columns: str) -> DataFrame:
    """rows as lists, in one column, of about BLOCK codes together."""
    n = 1 + (rows.agg(F.sum(F.size("codes"))).first()[0] or 0) // BLOCK
    block = F.pmod(F.xxhash64("k"), F.lit(n)).alias("block")
    return stored(rows.select(block, F.struct(*columns).alias("side")).repartition(n, "block").groupBy("block").agg(F.collect_list("side").alias(name)).select(name), f"audio-{name}")


def align(prints: DataFrame, query_step: int = QUERY_STEP, most_errors: float = MOST_ERRORS) -> DataFrame:
    """Every recording against the queries, which are those whose id query_step divides.

    Columns: rec_id, class_id (the least id with the same codes), n_codes, n_matches (query classes, other than its own, that align),
    best_query (the query with the fewest bit errors, then the least id), best_offset (places by which the query lies ahead) and best_errors.
    Recordings with equal codes are one class, compared once. Every query meets every class at every offset with at least LEAST_OVERLAP
    codes in common, in blocks; the offset with the fewest bit errors wins (then the least). No index stands before it: a pair with
    most_errors of its bits changed need not share one code, nor a run of five bits of one.
    Recordings without codes match nothing; a null rec_id is never a query; an empty table gives an empty one.
    """
    prints = stored(prints, "audio-prints")
    query = F.when(F.col("rec_id") % query_step == 0, F.col("rec_id"))
    classes = prints.where(F.size("codes") > 0).groupBy("codes").agg(F.min("rec_id").alias("class_id"), F.min(query).alias("query_id"))
    classes = stored(classes.withColumn("k", F.xxhash64("codes")), "audio-classes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                asked, other = (batch.column(c).slice(r, 1).flatten() for c in (0, 1))
                parts = list(_by_length(other))
                for at, a in _by_length(asked):
                    for to, b in parts:
                        errors, offset = least_errors(a, b, most_errors)
                        x, y = np.nonzero(errors <= 1)
                        q, k = asked.take(pa.array(at[x])), other.field("k").take(pa.array(to[y]))
                        yield pa.record_batch([q.field("k"), q.field("query_id"), k, pa.array(offset[x, y]), pa.array(errors[x, y])], ["q", "query_id", "k", "offset", "errors"])

    asked = _blocks(classes.where("query_id is not null"), "asked", "k", "query_id", "codes")
    others = _blocks(classes, "others", "k", "codes")
    good = asked.crossJoin(others).mapInArrow(run, "q long, query_id long, k long, offset int, errors double").where("q <> k")
    found = good.groupBy("k").agg(F.count("*").alias("n_matches"), F.min(F.struct("errors", "query_id", "offset")).alias("best"))
    told = stored(classes.join(found, "k", "left").select("k", "class_id", F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"), F.col("best.query_id").alias("best_query"), F.col("best.offset").cast("int").alias("best_offset"), F.col("best.errors").alias("best_errors")), "audio-told")
    rows = prints.withColumn("n_codes", F.size("codes")).withColumn("k", F.when(F.size("codes") > 0, F.xxhash64("codes"))).drop("codes")
    return rows.join(told, "k", "left").select("rec_id", F.when(F.col("k").isNull(), F.col("rec_id")).otherwise(F.col("class_id")).alias("class_id"), "n_codes", F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"), "best_query", "best_offset", "best_errors")


@lru_cache(maxsize=1)
def _tones() -> np.ndarray:
    """A note of each of 24 semitones from A3 on, FRAME samples long."""
    t = np.arange(FRAME) / RATE
    return np.stack([np.sin(2 * np.pi * 220 * 2 ** (s / 12) * t) for s in range(24)]) * 100


def rendered(vectors: DataFrame) -> DataFrame:
    """rec_id and media: each vector played as a tune, an 8-bit WAV file. There are no recordings among the tables, so tunes stand in.

    Two components are one of eight notes, by their signs and which is larger. A null vector gives null media.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), 500):
                batch, out = whole.slice(begin, 500), []
                for v in batch.column(1).to_pylist():
                    if v is None:
                        out.append(None)
                        continue
                    x = np.nan_to_num(np.array(v, float))
                    x = x[: len(x) // 2 * 2].reshape(-1, 2)
                    notes = SCALE[4 * (x[:, 0] > 0) + 2 * (x[:, 1] > 0) + (np.abs(x[:, 0]) > np.abs(x[:, 1]))]
                    file = io.BytesIO()
                    with wave.open(file, "wb") as f:
                        f.setnchannels(1)
                        f.setsampwidth(1)
                        f.setframerate(RATE)
                        f.writeframes((_tones()[notes].reshape(-1) + 128).astype(np.uint8).tobytes() if len(notes) else b"")
                    out.append(file.getvalue())
                yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(out, pa.binary())], ["rec_id", "media"])

    return vectors.select(F.col("vec_id").alias("rec_id"), "embedding").mapInArrow(run, "rec_id long, media binary")
