"""Toxicity by a classifier chain of linear models on hashed words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from .common import affix_hashes, text_bytes, word_hashes

BITS = 18
#: At most so many labelled rows, the first by a hash of the id, are used to fit the models; scoring covers all rows.
FIT_ROWS = 6000
FOLDS = 5
STEPS = 150
#: Features that get a weight in a model.
KEEP = 2000
#: A word counts as a feature if so many of the fitting rows have it.
LEAST = 3
THRESHOLD = 0.5
#: Categories in the chain's order: name and the SQL condition on the labels.
CATEGORIES = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"))


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Places of the distinct features of the whole text, in lower case: words without marks at either end, their first
    four, five and six bytes (stems), and the last three bytes of words as they stand (marks, endings)."""
    if not text:
        return np.zeros(0, np.int64)
    text = text.lower()
    found = [affix_hashes(text_bytes(text), -3)]
    data = text_bytes(text.translate(_EDGES))
    found += [word_hashes(data), *(affix_hashes(data, n) for n in STEMS)]
    return np.unique(np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)


STEMS = (4, 5, 6)
_EDGES = {ord(c): " " for c in ".,;:!?\"'()[]{}<>*%&$#@/\\|~`^+=_-"}


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def total_weight(words: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    lengths = np.array([len(w) for w in words], np.int64)
    if not lengths.sum():
        return np.zeros(len(words))
    return np.bincount(np.repeat(np.arange(len(words)), lengths), weights[np.concatenate(words)], len(words))


def _blocks(words: list[np.ndarray], rows: int = 500) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and their rows, some rows at a time: all rows at once would fill the driver's memory."""
    for first in range(0, len(words), rows):
        part = words[first : first + rows]
        yield np.concatenate(part), np.repeat(np.arange(first, first + len(part)), [len(w) for w in part])


def fit_linear(words: list[np.ndarray], dense: np.ndarray, y: np.ndarray, size: int, keep: int = KEEP, penalty: float = 1e-4, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights of hashed features and of the dense columns (the last is the intercept): Adam on balanced logistic loss.

    Only the keep features whose log odds differ most between the classes, in standard errors, get a weight.
    """
    yes, both = np.zeros(size), np.zeros(size, np.int64)
    for at, row in _blocks(words):
        yes += np.bincount(at, y[row], size)
        both += np.bincount(at, minlength=size)
    a, b, n_yes, n_no = yes + 0.5, both - yes + 0.5, y.sum() + 1, len(y) - y.sum() + 1
    odds = np.abs(np.log(a / (n_yes - a + 0.5)) - np.log(b / (n_no - b + 0.5))) / np.sqrt(1 / a + 1 / b)
    best = np.argsort(np.where(both >= min(LEAST, max(1, len(words) // 50)), -odds, 1.0), kind="stable")[:keep]
    column = np.full(size, -1)
    column[best] = np.arange(len(best))
    chosen = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for at, row in _blocks(words):
        inside = column[at] >= 0
        chosen.append((column[at][inside], row[inside]))
    at, row = (np.concatenate(x) for x in zip(*chosen, strict=True))
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
    theta = [np.zeros(len(best)), np.zeros(dense.shape[1])]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, steps + 1):
        z = np.bincount(row, theta[0][at], len(words)) + dense @ theta[1]
        r = (sigmoid(z) - y) * weight
        for k, g in enumerate((np.bincount(at, r[row], len(best)) + penalty * theta[0], dense.T @ r)):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            theta[k] = theta[k] - 0.1 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-9)
    weights = np.zeros(size)
    weights[best] = theta[0]
    return weights, theta[1]


class Chain:
    """One linear model for each category; each sees the words and the probabilities of the categories before it."""

    def __init__(self, names: list[str], bits: int = BITS):
        self.names, self.bits = names, bits
        self.models: list[tuple[np.ndarray, np.ndarray]] = []

    def fit(self, words: list[np.ndarray], labels: np.ndarray, fold: np.ndarray) -> Chain:
        """Later models are trained on out-of-fold probabilities: those a model gives to rows it hasn't seen."""
        size, earlier = 1 << self.bits, np.zeros((len(words), 0))
        for k in range(labels.shape[1]):
            y, dense = labels[:, k].astype(float), np.column_stack((earlier, np.ones(len(words))))
            fresh = np.full(len(words), y.mean() if len(y) else 0.0)
            for f in np.unique(fold) if k + 1 < labels.shape[1] else ():
                inside, out = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                if len(inside):
                    w, d = fit_linear([words[i] for i in inside], dense[inside], y[inside], size)
                    fresh[out] = sigmoid(total_weight([words[i] for i in out], w) + dense[out] @ d)
            self.models.append(tuple(x.astype(np.float32) for x in fit_linear(words, dense, y, size)))
            earlier = np.column_stack((earlier, fresh))
        return self

    def probabilities(self, words: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(words), 0))
        for w, d in self.models:
            p = sigmoid(total_weight(words, w) + np.column_stack((out, np.ones(len(words)))) @ d)
            out = np.column_stack((out, p))
        return out


def train(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, fit_rows: int = FIT_ROWS, folds: int = FOLDS, bits: int = BITS) -> Chain | None:
    """The chain fitted on a bounded sample of labelled documents, or None without any. Ids with several labels count as the highest.

    Of documents with one id the one whose text has the least hash counts; a task keeps one for each id, so repeated rows don't reach the driver.
    """
    flags = [F.max(F.when(F.expr(c), 1).otherwise(0)).alias(f"label_{k}") for k, (_, c) in enumerate(categories)]
    names = [f"label_{k}" for k in range(len(categories))]
    there = docs.select("doc_id").where("doc_id is not null").distinct()
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(*flags).join(there, "doc_id", "left_semi")
    known = known.orderBy(F.xxhash64(F.lit("fit"), "doc_id"), "doc_id").limit(fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        for batch in batches:
            for k, (doc_id, h) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("h").to_pylist(), strict=True)):
                if doc_id not in best or h < best[doc_id][0]:
                    best[doc_id] = (h, [batch.column(n)[k].as_py() for n in names], features(batch.column("text")[k].as_py(), bits).astype(np.int32))
        for doc_id, (h, flag, words) in best.items():
            yield pa.record_batch([pa.array([doc_id], pa.int64()), pa.array([h]), *(pa.array([f], pa.int32()) for f in flag), pa.array([words], pa.list_(pa.int32()))], ["doc_id", "h", *names, "words"])

    # the sample is bounded by fit_rows, so it may be broadcast; its hashed words, one row for each id, come to the driver
    sample = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).join(F.broadcast(known), "doc_id").select("doc_id", "h", "text", *names)
    found = sample.mapInArrow(run, f"doc_id long, h long, {', '.join(f'{n} int' for n in names)}, words array<int>")
    got = found.groupBy("doc_id").agg(F.min(F.struct("h", *names, "words")).alias("b")).select("doc_id", *(f"b.{n}" for n in names), "b.words").toArrow().sort_by("doc_id")
    if not len(got):
        return None
    ids = got["doc_id"].to_numpy()
    flags_of = np.column_stack([got[n].to_numpy() for n in names])
    lists = got["words"].combine_chunks()
    flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    del got
    fold = (ids * 0x9E3779B1 % 2**32) // 65536 % folds
    return Chain([n for n, _ in categories], bits).fit([flat[ends[i] : ends[i + 1]] for i in range(len(ids))], flags_of, fold)


def score(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, threshold: float = THRESHOLD, reject: str = "toxic", **fit) -> DataFrame:
    """All columns of docs, with p_<category> (double) for each category and rejected (p of reject >= threshold).

    The models are fitted on at most FIT_ROWS labelled rows; every whole text is scored. A null or empty text has no
    words and is never rejected; without labels all probabilities are 0. Columns of docs with the new names are replaced.
    """
    names = [f"p_{n}" for n, _ in categories]
    docs = docs.drop(*names, "rejected")
    chain = train(docs, labels, categories, **fit)
    held = docs.sparkSession.sparkContext.broadcast(chain)  # of constant size: 2^BITS weights a category
    schema = StructType([*docs.schema.fields, *(StructField(n, DoubleType()) for n in names), StructField("rejected", BooleanType())])
    which = [n for n, _ in categories].index(reject)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                words = [features(t, model.bits if model else BITS) for t in batch.column("text").to_pylist()]
                p = model.probabilities(words) if model else np.zeros((len(words), len(names)))
                bad = (p[:, which] >= threshold) & np.array([len(w) > 0 for w in words], bool)
                yield pa.record_batch([*batch.columns, *(pa.array(p[:, k]) for k in range(len(names))), pa.array(bad)], [*batch.schema.names, *names, "rejected"])

    return docs.mapInArrow(run, schema)
