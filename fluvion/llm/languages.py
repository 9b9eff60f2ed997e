"""Language identification: the nearest of several centroids per language, by the cosine of TF-IDF vectors of letter n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from .common import mix

#: n-grams of one to GRAM letters, hashed to 2^BITS features.
GRAM, BITS = 3, 14
#: At most so many distinct texts of each language, the first by a hash of the text, and of so many languages, the most frequent, fit the centroids.
FIT_TEXTS, FIT_LANGUAGES = 250, 200
#: Ranges of hashes, by so many leading bits, in which a language's texts are counted to find its first ones.
RANGE_BITS = 10
#: Centroids of a language, and rounds of clustering.
CENTROIDS, ROUNDS = 4, 12
#: A text is rejected if it is farther from its centroid than all but this share of the language's fitting texts.
REJECTED_SHARE = 0.005
#: Code points of a text that are taken at once.
STRETCH = 1 << 17
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(k).isalpha() for k in range(0x110000)])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(letters()[code_points(text[k : k + STRETCH])].any() for k in range(0, len(text), STRETCH))


def counts(text: str | None, bits: int = BITS, gram: int = GRAM) -> np.ndarray:
    """How often each feature occurs in the whole text, in lower case: runs of letters, with one blank for whatever lies between words."""
    total = np.zeros(1 << bits, np.int64)
    carried = np.array([32], np.uint32)  # the last letters of the stretch before
    for at in range(0, len(text or ""), STRETCH):
        codes = code_points(text[at : at + STRETCH].lower())
        codes = np.where(letters()[codes], codes, np.uint32(32))
        codes = np.concatenate((carried, codes, [np.uint32(32)] if at + STRETCH >= len(text) else [])).astype(np.uint32)
        first = len(carried) if at else 0
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
        first = int(keep[:first].sum())
        codes = codes[keep].astype(np.uint64)
        h = np.zeros(len(codes), np.uint64)
        for n in range(1, gram + 1):
            if len(codes) < n:
                break
            h = h[: len(codes) - n + 1] * np.uint64(0x110001) + codes[n - 1 :] + np.uint64(1)
            # n-grams that end in the stretch itself; a blank alone is none
            new = h[max(0, first - n + 1) :]
            new = new[new != 33] if n == 1 else new
            total += np.bincount((mix(new) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        carried = codes[-max(gram - 1, 1) :].astype(np.uint32)
    return total


def weighted(found: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and their TF-IDF weights, scaled to length 1."""
    at = np.flatnonzero(found)
    w = (1 + np.log(found[at])) * idf[at]
    length = np.sqrt(w @ w)
    return (at, w / length) if length > 0 else (at[:0], w[:0])


def sums_of_texts(docs: DataFrame, bits: int = BITS) -> tuple[int, np.ndarray]:
    """The number of texts with a letter, and for each feature the number of texts that have it, over all rows; a task adds up its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, having = 0, np.zeros(1 << bits, np.int64)
        for batch in batches:
            for value in batch.column(0):
                found = counts(value.as_py(), bits)
                texts += bool(found.any())
                having += found > 0
        at = np.flatnonzero(having)
        yield pa.record_batch([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(having[at], texts))], ["feature", "n"])

    got = docs.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()  # one row for each feature
    feature, n = got["feature"].to_numpy(), got["n"].to_numpy()
    having = np.zeros(1 << bits, np.int64)
    having[feature[feature >= 0]] = n[feature >= 0]
    return int(n[feature < 0].sum()), having


def cluster(x: np.ndarray, k: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart rows of x: centroids of length 1, and each row's cosine with its own."""
    start = [int(np.argmax(x @ x.sum(axis=0)))]  # the most typical row
    near = x @ x[start[0]]
    while len(start) < min(k, len(x)):
        far = int(np.argmin(near))
        if near[far] > 1 - 1e-9:
            break
        start.append(far)
        near = np.maximum(near, x @ x[far])
    centroids = x[start]
    for _ in range(rounds):
        at = np.argmax(x @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, x)
        used = np.bincount(at, minlength=len(centroids)) > 0
        sums[used] /= np.linalg.norm(sums[used], axis=1, keepdims=True)
        centroids = np.where(used[:, None], sums, centroids)
    return centroids, (x @ centroids.T).max(axis=1)


@dataclass
class Model:
    """Centroids as columns, the language of each, and the least cosine that a text of the language is accepted at."""

    names: list[str]
    owner: np.ndarray
    centroids: np.ndarray
    least: np.ndarray
    idf: np.ndarray
    bits: int

    def predict(self, text: str) -> tuple[str, float, bool]:
        at, w = weighted(counts(text, self.bits), self.idf)
        cosines = w @ self.centroids[at]
        k = int(np.argmax(cosines))
        score = min(max(float(cosines[k]), 0.0), 1.0)
        return self.names[self.owner[k]], score, score < self.least[self.owner[k]]


def fit(docs: DataFrame, fit_texts: int = FIT_TEXTS, centroids: int = CENTROIDS, bits: int = BITS) -> Model | None:
    """The model of the documents (text, lang), or None if none has a language and a letter.

    Features are weighed by the number of texts that have them, over all documents. Centroids are fitted on at most FIT_TEXTS distinct texts
    of a language, for at most FIT_LANGUAGES languages; the order of languages, texts and centroids doesn't depend on the rows' order.
    """
    docs = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    texts, having = sums_of_texts(docs, bits)
    if not texts:
        return None
    idf = np.log((1 + texts) / (1 + having)) + 1
    often = docs.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(FIT_LANGUAGES).select("lang")
    hashed = docs.select("lang", "text", F.xxhash64(F.lit("fit"), "text").alias("h"))
    # a language's first texts by hash: the ranges of hashes are counted, and only those up to the one in which the sample is full are ranked
    distinct = hashed.select("lang", "h").distinct().join(F.broadcast(often), "lang").withColumn("range", F.shiftrightunsigned("h", 64 - RANGE_BITS))
    ranges = distinct.groupBy("lang", "range").agg(F.count("*").alias("n"))
    by_range = Window.partitionBy("lang").orderBy("range")
    ranges = ranges.withColumn("before", F.sum("n").over(by_range) - F.col("n")).where(F.col("before") < fit_texts).select("lang", "range")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("range", "h"))
    chosen = distinct.join(ranges, ["lang", "range"]).withColumn("rank", rank).where(F.col("rank") <= fit_texts).select("lang", "h")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for k in range(len(batch)):
                key = (batch.column("lang")[k].as_py(), batch.column("h")[k].as_py())
                if key not in seen:  # copies of a text come once from a task
                    seen.add(key)
                    at, w = weighted(counts(batch.column("text")[k].as_py(), bits), idf)
                    lists = [pa.array([x.tolist()], pa.list_(t)) for x, t in ((at, pa.int32()), (w, pa.float64()))]
                    yield pa.record_batch([batch.column("lang")[k : k + 1], batch.column("h")[k : k + 1], *lists], ["lang", "h", "features", "weights"])

    def centre(group: pa.Table) -> pa.Table:
        group = group.sort_by("h")
        x = np.zeros((len(group), 1 << bits))
        for row in range(len(group)):
            x[row, group["features"][row].values.to_numpy()] = group["weights"][row].values.to_numpy()
        x = x[x.any(axis=1)]
        if not len(x):
            return pa.table({"lang": pa.array([], pa.string()), "number": pa.array([], pa.int32()), "centroid": pa.array([], pa.list_(pa.float32())), "least": pa.array([], pa.float64())})
        found, own = cluster(x, centroids)
        n, least = len(found), float(np.quantile(own, REJECTED_SHARE))
        return pa.table({"lang": pa.array([group["lang"][0].as_py()] * n), "number": pa.array(range(n), pa.int32()), "centroid": pa.array(found.astype(np.float32).tolist(), pa.list_(pa.float32())), "least": pa.array([least] * n)})

    # chosen has at most fit_texts texts of FIT_LANGUAGES languages; a language's are one group, of 2^bits features each at most
    sample = hashed.join(F.broadcast(chosen), ["lang", "h"]).mapInArrow(features, "lang string, h long, features array<int>, weights array<double>").dropDuplicates(["lang", "h"])
    got = sample.groupBy("lang").applyInArrow(centre, "lang string, number int, centroid array<float>, least double").toArrow().sort_by([("lang", "ascending"), ("number", "ascending")])
    if not len(got):
        return None
    names, owner = np.unique(np.array(got["lang"].to_pylist(), object), return_inverse=True)
    columns = got["centroid"].combine_chunks().flatten().to_numpy().reshape(len(got), -1).T
    least = np.array([got["least"][int(np.flatnonzero(owner == k)[0])].as_py() for k in range(len(names))])
    return Model(names.tolist(), owner, np.ascontiguousarray(columns), least, idf, bits)


def learned(docs: DataFrame) -> DataFrame:
    """The rows that a model may learn from: not held out, and not without an id."""
    return docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).select("text", F.col("lang").cast("string").alias("lang"))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, model: Model | None, reject_as: str | None = None) -> DataFrame:
    """docs with lang_pred, score (the cosine with the nearest centroid, 0 to 1) and rejected (too far from it).

    A null text and one without a letter are UNKNOWN with score 0, and so are all without a model. Rejected texts keep the nearest language
    unless reject_as names another value. Every whole text is read. Columns of docs with the new names are replaced.
    """
    names = ["lang_pred", "score", "rejected"]
    docs = docs.drop(*names)
    held = docs.sparkSession.sparkContext.broadcast(model)  # FIT_LANGUAGES x CENTROIDS x 2^BITS numbers at most
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            found = []
            for value in batch.column("text"):
                text = value.as_py()
                lang, score, rejected = model.predict(text) if model and has_letter(text) else (UNKNOWN, 0.0, True)
                found.append((reject_as if rejected and reject_as is not None else lang, score, bool(rejected)))
            new = zip(*found, strict=True) if found else ((), (), ())
            yield pa.record_batch([*batch.columns, *(pa.array(c, k) for c, k in zip(new, (pa.string(), pa.float64(), pa.bool_()), strict=True))], [*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)
