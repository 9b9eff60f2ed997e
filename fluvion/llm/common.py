"""Shared helpers: written intermediate tables, vectorised word hashing and connected components."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = (1 << 64) - 1
#: Bases of the hash of a word's bytes, each modulo a prime below 2^31: a polynomial modulo a power of two would take words that differ
#: by the Thue-Morse order of two letters for equal.
_FIELDS = ((2_147_483_647, 1_103_515_245), (2_147_483_629, 1_664_525_017))
_GRAM = 0xD6E8FEB86659FD93
#: Words end at these bytes: U+0020 and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Long texts are hashed in stretches of about this many bytes, short ones together.
STRETCH = 1 << 15
#: Sums of so many products of a byte and a power stay below 2^64.
SHORT = 1 << 24
#: Edges of a graph that a task contracts at once: some 100 MB at work.
PIECE = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="checkpoint-")


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir).

    Where the setting is missing, a local session gets a temporary folder; a cluster gets an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    files, hadoop = _filesystem(spark, path)
    files.deleteOnExit(hadoop)
    return path


_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a written table: cuts the lineage, survives lost executors and fixes the rows for later passes."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of stored() that nothing yet to run reads."""
    for t in tables:
        if path := _PATHS.pop(t, None):
            files, hadoop = _filesystem(t.sparkSession, path)
            files.delete(hadoop, True)


def keyed(docs: DataFrame, name: str) -> DataFrame:
    """docs with a long key of each row's file and place there: rows equal in all columns get keys of their own, the same in every pass.

    A table that isn't read straight from files is stored first.
    """
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    try:
        return docs.withColumn(name, place)
    except AnalysisException:
        return stored(docs, "keyed").withColumn(name, place)


def numbered(df: DataFrame, name: str = "row_key") -> DataFrame:
    """A long key for each row of a written table, from the rows' files and their places in them."""
    place = F.struct(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), F.col("_metadata.row_index"))
    return df.withColumn(name, F.xxhash64(place))


def text_bytes(value) -> bytes:
    return b"" if value is None else value.encode("utf-8", "surrogatepass")


_POWERS: list[tuple[np.ndarray, np.ndarray]] = [(np.ones(1, np.uint64), np.ones(1, np.uint64))] * len(_FIELDS)


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each field the first n powers of the base and of its inverse."""
    for k, (prime, base) in enumerate(_FIELDS):
        if len(_POWERS[k][0]) < n:
            grown = []
            for b, have in zip((base, pow(base, -1, prime)), _POWERS[k], strict=True):
                while len(have) < n:
                    have = np.concatenate((have, have * np.uint64(pow(b, len(have), prime)) % np.uint64(prime)))
                grown.append(have)
            _POWERS[k] = tuple(grown)
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of UTF-8 text, in order."""
    if len(data) <= STRETCH:
        return _stretch(data)
    parts, at = [], 0
    while at < len(data):
        end = min(at + STRETCH, len(data))
        if end < len(data):
            found = re.compile(rb"[ \t-\r]").search(data, end)
            end = found.start() if found else len(data)
        parts.append(_stretch(data[at:end]))
        at = end
    return np.concatenate(parts)


def hashes_of_texts(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """word_hashes of each text, of many short ones at once."""
    held: list[bytes] = []
    size = 0

    def together() -> Iterator[np.ndarray]:
        starts, ends, totals = _edges(b" ".join(held))
        found = _hash(totals, starts, ends)
        edges = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in held)])).tolist()
        return (found[i:j] for i, j in zip(edges[:-1], edges[1:], strict=True))

    for text in texts:
        if held and size + len(text) > STRETCH:
            yield from together()
            held, size = [], 0
        if len(text) > STRETCH:
            yield word_hashes(text)
        else:
            held.append(text)
            size += len(text) + 1
    if held:
        yield from together()


def _edges(data: bytes) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Starts and ends of words, and for each field running sums of the bytes' powers."""
    b = np.frombuffer(data, np.uint8)
    inside = np.concatenate(([False], ~SPACE[b], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    letters, totals = b.astype(np.uint64) + np.uint64(1), []
    for (prime, _), (up, _) in zip(_FIELDS, _powers(len(b) + 1), strict=True):
        total = np.zeros(len(b) + 1, np.uint64)
        terms = letters * up[: len(b)]
        np.cumsum(terms if len(b) < SHORT else terms % np.uint64(prime), out=total[1:])
        totals.append(total)
    return edge[::2], edge[1::2], totals


def _hash(totals: list[np.ndarray], starts: np.ndarray, ends: np.ndarray, tag: int = 0) -> np.ndarray:
    parts = []
    for (prime, _), (_, down), total in zip(_FIELDS, _powers(len(totals[0])), totals, strict=True):
        parts.append((total[ends] - total[starts]) % np.uint64(prime) * down[starts] % np.uint64(prime))
    return mix((parts[0] << np.uint64(32) | parts[1]) + ((ends - starts).astype(np.uint64) + np.uint64(tag << 32)) * np.uint64(_GRAM))


def _stretch(data: bytes) -> np.ndarray:
    starts, ends, totals = _edges(data)
    return _hash(totals, starts, ends)


def affix_hashes(data: bytes, n: int) -> np.ndarray:
    """A hash of the first n bytes (the last -n, if n is negative) of each word that has more."""
    parts = []
    for at in range(0, max(len(data), 1), STRETCH):  # a word across a border counts as two here
        starts, ends, totals = _edges(data[at : at + STRETCH])
        long = ends - starts > abs(n)
        starts, ends = starts[long], ends[long]
        parts.append(_hash(totals, starts, starts + n, n) if n > 0 else _hash(totals, ends + n, ends, 64 - n))
    return np.concatenate(parts)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of k words; empty if there are fewer."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out, size, part, width, rest = None, 0, h, 1, k
    while rest:
        if rest & 1:
            if out is None:
                out, size = part, width
            else:
                n = len(h) - size - width + 1
                out = out[:n] * np.uint64(pow(_GRAM, width, 1 << 64)) + part[size : size + n]
                size += width
        rest >>= 1
        if rest:
            n = len(h) - 2 * width + 1
            part = part[:n] * np.uint64(pow(_GRAM, width, 1 << 64)) + part[width : width + n]
            width *= 2
    return mix(out)


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """The least of each width neighbouring values."""
    n, have = len(a) - width + 1, 1
    while have * 2 <= width:
        a = np.minimum(a[: len(a) - have], a[have:])
        have *= 2
    return np.minimum(a[:n], a[width - have : width - have + n])


def _contracted(edges: DataFrame, piece: int, roots: bool = False) -> DataFrame:
    """Every node u of a piece of edges (u, v) with v, the least node that the piece's edges lead to; that node itself only if roots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stars() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            ends = np.concatenate([rows["u"].to_numpy(), rows["v"].to_numpy()])
            names, at = np.unique(ends, return_inverse=True)
            root = np.arange(len(names))
            union(root, at[: len(rows)], at[len(rows) :])
            given = np.arange(len(names)) if roots else np.flatnonzero(root != np.arange(len(names)))
            return pa.record_batch([pa.array(names[given]), pa.array(names[root[given]])], ["u", "v"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if len(batch):
                held.append(batch)
            if sum(map(len, held)) >= piece:
                yield stars()
                held = []
        if held:
            yield stars()

    return edges.mapInArrow(run, "u long, v long")


def components(edges: DataFrame, name: str = "components", rounds: int = 60, piece: int = PIECE) -> DataFrame:
    """(node, component): the least node that each node of edges (a, b) reaches. Nodes without an edge get no row.

    Each piece of edges is contracted in a task, to a star for each part that hangs together in it; a graph of one piece is done then.
    The stars of several pieces are joined by large-star and small-star steps in turn; every step is an aggregate and a join, so a
    node with many edges is never gathered in one place. Each round is a written table; the one before it is deleted. Paths halve
    in every round, so a graph that is not done after rounds rounds raises an error.
    """
    given = stored(edges.where("a <> b").select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")), f"{name}-edges")
    pieces = math.ceil(given.count() / piece)
    if pieces <= 1:
        return stored(_contracted(given.coalesce(1), 2 * piece, roots=True).toDF("node", "component"), name)
    e = stored(_contracted(given.coalesce(pieces), piece).distinct(), name)
    discard(given)

    def star(pairs: DataFrame) -> DataFrame:
        return pairs.join(pairs.groupBy("u").agg(F.min("v").alias("m")), "u")

    mark = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(star(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct(), f"{name}-large")
        small = star(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        small = stored(small, name)
        discard(e, large)
        e = small
        seen = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = seen
    raise RuntimeError(f"components: not done after {rounds} rounds")


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches that are sorted by keys (without nulls); for many small groups, which cost a call each otherwise."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        edges = [0, *new.tolist(), len(batch)]
        for k in range(len(edges) - 1):
            key = tuple(c[edges[k]] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(edges[k], edges[k + 1] - edges[k]))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def union(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of a[k] and b[k] for every k, in place: root holds the least member of each place's set."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]
