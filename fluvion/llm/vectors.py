"""Near-duplicate vectors by a pivot-permutation index."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import components, discard, stored, union

COSINE = 0.95
#: The index's sample: this many vectors for each square root of the number of distinct vectors, within bounds. Pivots are those of the sample
#: that are not within a separation of an earlier one: two pivots in one dense cluster would only cut it in halves. The separation is this share
#: of the way from the sample's median cosine to 1, so that vectors that all lie in a narrow cone have many pivots, too.
PIVOTS_PER_ROOT, LEAST_PIVOTS, MOST_PIVOTS = 1.2, 16, 32_768
SEPARATION = 0.7
#: A vector stands in the lists of its nearest pivots, and is described by half as many more. How many these are is fitted: so that of pairs
#: of the sample's vectors and vectors at just the cosine, in random directions, this share meets. Beyond MOST_LISTS pivots are halved instead.
TARGET, TRIALS, MOST_LISTS = 0.98, 512, 24
#: Candidates share so many of the pivots that describe them.
SHARED = 2
#: Rows of a list that are compared in one piece.
BLOCK = 4096


def usable(embedding: str = "embedding"):
    """Vectors with a direction: not null, no null or non-finite component, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(embedding).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(embedding, lambda x: x != 0)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length, scaled to length 1 in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def choose_pivots(sample: pa.Array | pa.ChunkedArray, cosine: float = COSINE, separation: float = SEPARATION) -> tuple[dict[int, tuple[int, np.ndarray]], int]:
    """Of each dimension, the number of its first pivot and the pivots, in the sample's order and none near an earlier one; and the number of lists.

    Of a dimension's sample the last TRIALS, half of it at most, only serve to fit the number of lists.
    """
    sample = sample.combine_chunks() if isinstance(sample, pa.ChunkedArray) else sample
    lengths = sample.value_lengths().to_numpy(zero_copy_only=False)
    out, first, most = {}, 0, 1
    for size in np.unique(lengths).tolist():
        x = matrix(sample.take(pa.array(np.flatnonzero(lengths == size))))
        middle = max(0.0, float(np.median(x[: TRIALS // 2] @ x[-TRIALS // 2 :].T))) if len(x) > 2 else 0.0
        near, kept = middle + (1 - middle) * separation, x[:0]
        tried = min(TRIALS, len(x) // 2)  # these become no pivots: a pivot finds itself
        for at in range(0, len(x) - tried, 256):
            block = x[at : min(at + 256, len(x) - tried)]
            block = block[(block @ kept.T).max(axis=1, initial=-1.0) < near]
            chosen: list[int] = []
            alike = block @ block.T
            for k in range(len(block)):
                if not chosen or alike[k, chosen].max() < near:
                    chosen.append(k)
            kept = np.concatenate((kept, block[chosen]))
        pivots, lists = fitted(kept, x[len(x) - tried :], cosine)
        out[size] = (first, pivots)
        first, most = first + len(pivots), max(most, lists)
    return out, most


def fitted(pivots: np.ndarray, x: np.ndarray, cosine: float = COSINE) -> tuple[np.ndarray, int]:
    """Pivots, fewer if need be, and the number of lists by which TARGET of the pairs of x and vectors at that cosine are found."""
    rng = np.random.default_rng(len(x))
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(axis=1, keepdims=True) * x
    length = np.linalg.norm(aside, axis=1, keepdims=True)
    y = cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * np.divide(aside, length, out=np.zeros_like(aside), where=length > 0)
    while True:
        a, b = (np.argsort(-(v @ pivots.T), axis=1, kind="stable") for v in (x, y))
        for lists in range(3, MOST_LISTS + 1):
            wide = nearest_of(lists)
            home = (b[:, :lists] == a[:, :1]).any(axis=1) | (a[:, :lists] == b[:, :1]).any(axis=1)
            shared = (a[:, :wide, None] == b[:, None, :wide]).sum(axis=(1, 2)) >= min(SHARED, len(pivots))
            if (len(x) and (home & shared).mean() >= TARGET) or lists >= len(pivots):
                return pivots, min(lists, len(pivots))
        pivots = pivots[: len(pivots) // 2]


def nearest_of(lists: int) -> int:
    """Pivots that describe a vector."""
    return lists + lists // 2 + 1


def describe(classes: DataFrame, pivots: dict[int, tuple[int, np.ndarray]], nearest: int) -> DataFrame:
    """Each vector with its permutation: its nearest pivots, nearest first. Vectors of a dimension without pivots share one of their own."""
    held = classes.sparkSession.sparkContext.broadcast(pivots)  # at most MOST_PIVOTS vectors
    names = classes.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), 1000):
                batch = whole.slice(begin, 1000)
                sizes = batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
                for size in np.unique(sizes).tolist():
                    rows = batch.take(pa.array(np.flatnonzero(sizes == size)))
                    first, centres = held.value.get(size, (-1 - size, None))
                    if centres is None:
                        order = np.full((len(rows), 1), first)
                    else:
                        order = first + np.argsort(-(matrix(rows.column("embedding")) @ centres.T), axis=1, kind="stable")[:, :nearest]
                    flat = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * order.shape[1], pa.int32()), pa.array(order.reshape(-1), pa.int32()))
                    yield pa.record_batch([*rows.columns, flat], [*names, "permutation"])

    return classes.mapInArrow(run, classes.withColumn("permutation", F.lit(None).cast("array<int>")).schema)


def compare(key: int, rows: pa.Table, cosine: float, lists: int, shared: int = SHARED) -> tuple[np.ndarray, np.ndarray]:
    """Of one pair of blocks of the list key (sides 0 and 1, or 0 alone): how many others each row gains, and for each the least row of those it is linked to.

    Candidates are pairs of which at least one is at home in the list (its nearest pivot is the list's) that share enough pivots, by the
    product of the rows' incidence with pivots; their cosines are verified. A pair that meets in two lists counts in the first.
    """
    n, side = len(rows), rows["side"].to_numpy()
    x = matrix(rows["embedding"])
    order = rows["permutation"].combine_chunks().flatten().to_numpy().reshape(n, -1)
    home, copies = order[:, 0], rows["copies"].to_numpy()
    local, at = np.unique(order, return_inverse=True)
    has = np.zeros((n, len(local)), np.float32)
    has[np.arange(n)[:, None], at.reshape(n, -1)] = 1
    gain, root = np.zeros(n, np.int64), np.arange(n)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = not len(right)
    right = left if alone else right
    least = min(shared, order.shape[1])
    for begin in range(0, len(left), 256):
        a = left[begin : begin + 256]
        candidates = (has[a] @ has[right].T >= least) & ((home[a] == key)[:, None] | (home[right] == key)[None, :])
        i, j = np.nonzero(candidates & (x[a] @ x[right].T >= cosine))
        i, j = a[i], right[j]
        if alone:
            i, j = i[i < j], j[i < j]
        # of a pair with two homes the one at home here may also stand in the other's list
        host, guest = np.where(home[i] == key, i, j), np.where(home[i] == key, j, i)
        other = home[guest]
        there = (order[host, :lists] == other[:, None]).any(axis=1) & (other < key)
        i, j = i[~there], j[~there]
        gain += np.bincount(i, copies[j], n).astype(np.int64) + np.bincount(j, copies[i], n).astype(np.int64)
        union(root, i, j)
    return gain, root


def near_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector.

    Vectors are linked if their cosine, in double precision, is at least cosine. A sample of vectors, the first by a hash, gives the
    pivots; it grows with the root of the number of distinct vectors and is at most MOST_PIVOTS, so that beyond 700 million distinct
    vectors lists grow with their number. Every vector is described by its nearest pivots in order, the first of which is its home, and stands in the
    inverted lists of the first of them; how many is fitted to the sample (see TARGET). Two vectors meet in a list that is home to one of them; if they share SHARED of their
    nearest pivots, their cosine is verified. Lists are compared in pairs of blocks, which give counts and the edges of a
    forest, never their pairs. Equal vectors are one class and are expanded nowhere.
    Null vectors, vectors of zeros and those with null or non-finite components link with nothing; so do vectors of different
    dimensions. Rows with equal ids are different vectors, linked or not by their components alone. A null vec_id counts as the largest; kept is
    false for it. Labels and other columns are ignored; an empty table gives an empty one.
    """
    kind = vectors.schema["embedding"].dataType
    kind = "array<double>" if isinstance(kind, ArrayType) and isinstance(kind.elementType, DoubleType) else "array<float>"
    rows = vectors.select("vec_id", F.col("embedding").cast(kind).alias("embedding"))
    good = rows.where(usable()).withColumns({"k1": F.xxhash64("embedding"), "k2": F.xxhash64(F.lit("second"), "embedding")})
    classes = good.groupBy("k1", "k2").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")  # numbers are fixed by the write
    wanted = min(MOST_PIVOTS, max(LEAST_PIVOTS, math.ceil(PIVOTS_PER_ROOT * math.sqrt(classes.count()))))
    sample = classes.orderBy(F.xxhash64(F.lit("pivot"), "k1"), "k2").limit(wanted + TRIALS).select("embedding").toArrow()
    pivots, lists = choose_pivots(sample["embedding"], cosine)
    described = stored(describe(classes, pivots, nearest_of(lists)), "vector-described")
    discard(classes)

    listed = described.withColumn("list", F.explode(F.slice("permutation", 1, lists)))
    sizes = stored(listed.groupBy("list").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks")), "vector-sizes")
    dealt = listed.join(sizes, "list").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # a block meets every block of its list once: as the left one those from itself on, as the right one those before it
    meets = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    sided = meets.select(
        "list", F.least("block", "other").cast("int").alias("block_x"), F.greatest("block", "other").cast("int").alias("block_y"), F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"), "node", "copies", "permutation", "embedding"
    )

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        gain, root = compare(key[0].as_py(), group, cosine, lists)
        hit, node = np.flatnonzero(gain), group["node"].to_numpy()
        return pa.table({"node": node[hit], "root": node[root[hit]], "gain": gain[hit]})

    linked = stored(sided.groupBy("list", "block_x", "block_y").applyInArrow(run, "node long, root long, gain long"), "vector-links")
    found = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-components")
    gains = linked.groupBy("node").agg(F.sum("gain").alias("gain"))
    nodes = described.select("node", "k1", "k2", "least_id", "copies").join(gains, "node", "left").join(found, "node", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "node")).withColumn("n_links", F.coalesce("gain", F.lit(0)) + F.col("copies") - 1)
    nodes = stored(nodes.select("k1", "k2", "least_id", "component", "n_links"), "vector-nodes")
    least = nodes.groupBy("component").agg(F.min("least_id").alias("component_id"))
    nodes = nodes.join(least, "component").select("k1", "k2", "n_links", "component_id")
    linked_rows = good.select("vec_id", "k1", "k2").join(nodes, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    others = rows.where(~usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_rows.unionByName(others).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
