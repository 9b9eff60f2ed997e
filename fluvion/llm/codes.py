"""Vector codes: each part of a vector is replaced by its nearest codebook entry, found in a vantage-point tree over integers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Components become floor(SCALE * x).
SCALE = 256
#: Integers of at least this size (x of 65,536 or more) leave a vector without a code: sums of their squares would leave 64 bits.
LARGEST = 1 << 24
#: Entries of a leaf.
LEAF = 6
#: Vectors that a task searches for at once.
BATCH = 8192


def root_down(square: np.ndarray) -> np.ndarray:
    """The largest integer whose square is at most square."""
    r = np.sqrt(square.astype(np.float64)).astype(np.int64)
    r -= r * r > square
    return r + ((r + 1) * (r + 1) <= square)


def root_up(square: np.ndarray) -> np.ndarray:
    """The least integer whose square is at least square."""
    r = root_down(square)
    return r + (r * r < square)


def squares(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Squared distances, in integers; both sides must have the same number of rows or one."""
    d = points - entry
    return np.einsum("ij,ij->i", d, d)


@dataclass
class Node:
    """A vantage entry and the shells around it: the inner entries lie no farther than near[1], the outer ones no nearer than far[0].

    Bounds are integers rounded away from the shell, so that they hold for the distances' true values. A leaf has entries only.
    """

    entries: np.ndarray
    near: tuple[int, int] = (0, 0)
    far: tuple[int, int] = (0, 0)
    inner: Node | None = None
    outer: Node | None = None


class VantageTree:
    """Nearest entries, of equally near ones that with the least index, by metric branch and bound."""

    def __init__(self, entries: np.ndarray, leaf: int = LEAF):
        self.entries = np.asarray(entries, np.int64)
        self.leaf = leaf
        self.visited = 0
        self.root = self._build(np.arange(len(entries)))

    def _build(self, left: np.ndarray) -> Node:
        if len(left) <= self.leaf:
            return Node(left)
        # the vantage entry is the one farthest from the first: its shells are the widest
        vantage = left[np.argmax(squares(self.entries[left], self.entries[left[:1]]))]
        rest = left[left != vantage]
        square = squares(self.entries[rest], self.entries[[vantage]])
        order = np.argsort(square, kind="stable")
        half = len(rest) // 2
        inner, outer = np.sort(rest[order[:half]]), np.sort(rest[order[half:]])

        def shell(s: np.ndarray) -> tuple[int, int]:
            return int(root_down(s[:1])[0]), int(root_up(s[-1:])[0])

        near, far = shell(square[order[:half]]), shell(square[order[half:]])
        return Node(np.array([vantage]), near, far, self._build(inner), self._build(outer))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each point its entry's index and their squared distance."""
        points = np.asarray(points, np.int64)
        best, least = np.zeros(len(points), np.int64), np.full(len(points), np.iinfo(np.int64).max)
        reach = np.full(len(points), np.iinfo(np.int64).max)  # least's root, rounded up

        def offer(rows: np.ndarray, entry: int) -> np.ndarray:
            square = squares(points[rows], self.entries[[entry]])
            better = (square < least[rows]) | ((square == least[rows]) & (entry < best[rows]))
            won = rows[better]
            best[won], least[won] = entry, square[better]
            reach[won] = root_up(square[better])
            return square

        def near_shell(rows: np.ndarray, down: np.ndarray, up: np.ndarray, shell: tuple[int, int]) -> np.ndarray:
            """Rows that the shell may hold something for: as near as the best so far, or nearer."""
            return np.maximum(down - shell[1], shell[0] - up) <= reach[rows]

        def visit(node: Node, rows: np.ndarray) -> None:
            if not len(rows):
                return
            self.visited += len(rows) * len(node.entries)
            if node.inner is None:
                for entry in node.entries.tolist():
                    offer(rows, entry)
                return
            square = offer(rows, int(node.entries[0]))
            down, up = root_down(square), root_up(square)
            inside = 2 * down <= node.near[1] + node.far[0]
            for first, then, shell, mask in ((node.inner, node.outer, (node.near, node.far), inside), (node.outer, node.inner, (node.far, node.near), ~inside)):
                at = np.flatnonzero(mask)
                for child, bounds in ((first, shell[0]), (then, shell[1])):
                    chosen = at[near_shell(rows[at], down[at], up[at], bounds)]
                    visit(child, rows[chosen])

        visit(self.root, np.arange(len(points)))
        return best, least


def integers(embedding: str | Column = "embedding", scale: int = SCALE) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))


def _kept(vectors: DataFrame) -> Column:
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return e.isNotNull() & F.coalesce(finite, F.lit(False))


def first_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """The parts of the vectors with the smallest ids, as parts x entries x components; of rows with one id those with the smaller vectors come first.

    None if there are no vectors with a length that parts divides. The length is that of the smallest id's vector.
    """
    wanted = vectors.where((F.size("q") > 0) & (F.size("q") % parts == 0)).orderBy(F.col("vec_id").asc_nulls_last(), "q")
    found = wanted.select("q").limit(1).collect()
    if not found:
        return None
    size = len(found[0].q)
    rows = [r.q for r in wanted.where(F.size("q") == size).select("q").limit(entries).collect()]
    return np.array(rows, np.int64).reshape(len(rows), parts, -1).transpose(1, 0, 2)


def _batches(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in batches:
        for at in range(0, len(whole), BATCH):
            batch = whole.slice(at, BATCH)
            if len(batch):
                yield batch, batch.column("q").flatten().to_numpy().astype(np.int64).reshape(len(batch), parts, -1)


def refine(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every part goes to its nearest entry, each entry becomes the floor of its parts' mean.

    A task adds up its own parts, so at most parts x entries sums leave it; entries without parts stay.
    """
    parts, entries, width = books.shape
    held = vectors.sparkSession.sparkContext.broadcast(books)  # of fixed size: parts x entries x width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [VantageTree(b) for b in held.value]
        total, count = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for _, q in _batches(batches, parts):
            for p, tree in enumerate(trees):
                at, _ = tree.nearest(q[:, p])
                count[p] += np.bincount(at, minlength=entries)
                for k in range(width):  # sums in double are exact: below LARGEST x BATCH
                    total[p, :, k] += np.bincount(at, q[:, p, k], entries).astype(np.int64)
        part, entry = np.nonzero(count)
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(total[part, entry].reshape(-1)))
        yield pa.record_batch([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]), sums], ["part", "entry", "n", "sums"])

    found = vectors.select("q").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    each = found.select("part", "entry", "n", F.posexplode("sums").alias("place", "x")).groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    got = each.toArrow()  # at most one row for each component of each entry
    out = books.copy()
    out[got["part"].to_numpy(), got["entry"].to_numpy(), got["place"].to_numpy()] = got["x"].to_numpy() // got["n"].to_numpy()
    return out


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """The columns of vectors without q, with code and error."""
    parts = len(books)
    held = vectors.sparkSession.sparkContext.broadcast(books)
    names = [c for c in vectors.columns if c != "q"]
    schema = vectors.select(*names).withColumns({"code": F.lit(None).cast("string"), "error": F.lit(None).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [VantageTree(b) for b in held.value]
        for batch, q in _batches(batches, parts):
            code, error = np.zeros((len(batch), parts), np.uint8), np.zeros(len(batch), np.int64)
            for p, tree in enumerate(trees):
                at, square = tree.nearest(q[:, p])
                code[:, p] = at
                error += square
            text = code.tobytes().hex()
            wide = 2 * parts
            yield pa.record_batch([*(batch.column(n) for n in names), pa.array([text[k * wide : k * wide + wide] for k in range(len(batch))]), pa.array(error)], [*names, "code", "error"])

    return vectors.mapInArrow(run, schema)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of every vector.

    Components become integers, vectors are cut into parts, each part has a codebook (at most 256 entries). It begins as that part of
    the vectors with the smallest ids and is refined in rounds. A part's entry is found in a vantage-point tree over the codebook, whose
    answers are exact: integer distances decide, and of equally near entries the one with the lower index. code holds two hex digits
    for each part, error the squared distances' sum, label_error that of all vectors with the label, codebooks_sha256 names the codebooks.
    Null vectors and those with null or non-finite components have no row. Vectors of a length that parts doesn't divide or that isn't
    the smallest id's, and those with components of 65,536 or more in size, have a row with a null code and error, and enter no
    codebook and no sum. Rows with equal ids are vectors of their own; a null vec_id counts as the largest; null labels are one label
    (its label_error is null if no row of it has a code). Fewer vectors than entries make smaller codebooks. An empty table gives
    an empty one. Other columns are ignored.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    # floor of a component beyond 64 bits would fail, so that vector's integers aren't taken
    sized = F.forall("embedding", lambda x: F.abs(x.cast("double") * scale) < LARGEST)
    rows = vectors.select("vec_id", "label", "embedding").where(_kept(vectors))
    rows = rows.select("vec_id", "label", F.when(sized, integers("embedding", scale)).alias("q"))
    rows = stored(rows, "codes-integers")
    good = rows.where(F.col("q").isNotNull())
    books = first_codebooks(good, parts, entries)
    if books is None:
        books = np.zeros((parts, 0, 0), np.int64)
        coded, others = None, rows
    else:
        size = parts * books.shape[2]
        fits = F.coalesce(F.size("q") == size, F.lit(False))
        good, others = rows.where(fits), rows.where(~fits)
        for _ in range(rounds):
            books = refine(good, books)
        coded = encode(good, books)
    others = others.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = stored(others if coded is None else coded.unionByName(others), "codes")
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    out = coded.join(sums, F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label")
    return out.withColumn("codebooks_sha256", F.lit(digest(books)))
