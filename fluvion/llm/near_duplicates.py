"""Near-duplicate texts by BagMinHash signatures over multisets of shingles, banding and exact verification."""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import MASK, components, discard, grams, hashes_of_texts, mix, runs_of, stored, text_bytes, union, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 30, 5
#: Pairs whose signatures agree less than the similarity by this much are not verified: about five standard errors.
SLACK = 0.16
#: Texts that one task compares with as many others.
BLOCK = 200
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and how often each occurs. A text of fewer words has one shingle, one without words none."""
    words = word_hashes(text_bytes(text))
    found = grams(words, size if len(words) >= size else max(len(words), 1))
    return np.unique(found, return_counts=True)


def bag_minhash(bags: list[tuple[np.ndarray, np.ndarray]], size: int = BANDS * BAND_ROWS) -> np.ndarray:
    """Signatures of weighted sets: two components are equal with the probability of the weighted Jaccard similarity.

    Weights are whole, so the levels 0, 1, 2, ... discretise them. The levels up to a weight are split as a hierarchy of
    blocks [0, 1), [1, 2), [2, 4), [4, 8), ...; each element has a Poisson process in each block, at a rate that is the block's
    width for every component. A point has a time, a component and a level in its block; it counts if its level is
    below the weight. A component is the time of its first point. All processes advance together, one point a round, and a
    process ends when its time is beyond all components of its set. An empty set gives zeros.
    """
    out = np.full((len(bags), size), np.inf)
    unit, owner, low, width, weight = [], [], [], [], []
    for k, (hashes, counts) in enumerate(bags):
        top, start, wide = int(counts.max()) if len(counts) else 0, 0, 1
        while start < top:
            some = counts > start if start else slice(None)
            h = hashes[some]
            unit.append(mix(h + np.uint64((wide + start) * int(_STEP) & MASK)))
            owner.append(np.full(len(h), k))
            low.append(np.full(len(h), start))
            width.append(np.full(len(h), wide))
            weight.append(counts[some])
            start, wide = start + wide, max(1, start + wide)
    if not unit:
        return np.zeros((len(bags), size), np.int64)
    unit, owner, low, width, weight = map(np.concatenate, (unit, owner, low, width, weight))
    time, state, flat = np.zeros(len(unit)), unit.copy(), out.reshape(-1)
    while len(unit):
        state = state + _STEP
        draw = mix(state)
        time = time - np.log1p(-((draw >> np.uint64(11)).astype(float) / 2.0**53)) / (width * size)
        at = mix(draw ^ unit)
        place = owner * size + (at >> np.uint64(40)).astype(np.int64) % size
        level = low + ((at & np.uint64(0xFFFFFFFF)).astype(np.int64) * width >> 32)
        counts = level < weight
        np.minimum.at(flat, place[counts], time[counts])
        alive = time < out.max(axis=1)[owner]
        if not alive.all():
            unit, owner, low, width, weight, time, state = (x[alive] for x in (unit, owner, low, width, weight, time, state))
    out[np.isinf(out).all(axis=1)] = 0
    return mix(out.view(np.uint64)).view(np.int64)


def band_keys(signatures: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    keys = np.empty((len(signatures), bands), np.uint64)
    s = signatures.view(np.uint64)
    for b in range(bands):
        h = np.full(len(s), b + 1, np.uint64)
        for r in range(rows):
            h = mix(h * _STEP + s[:, b * rows + r])
        keys[:, b] = h
    return keys.view(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The weighted Jaccard similarity of two multisets."""
    at = np.minimum(np.searchsorted(b[0], a[0]), max(len(b[0]) - 1, 0))
    same = b[0][at] == a[0] if len(b[0]) else np.zeros(len(a[0]), bool)
    both = np.minimum(a[1][same], b[1][at[same]]).sum()
    total = a[1].sum() + b[1].sum() - both
    return float(both / total) if total else 0.0


def signatures(docs: DataFrame) -> DataFrame:
    """row_hash, doc_id, k1, k2 (a cryptographic digest of the words themselves: rows with equal ones have equal words), bands and sig (a byte for each component) of texts with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 400):
                batch = whole.slice(at, 400)
                keep, keys, bags = [], [], []
                texts = [text_bytes(t) for t in batch.column("text").to_pylist()]
                for k, (text, words) in enumerate(zip(texts, hashes_of_texts(texts), strict=True)):
                    if len(words):
                        every = grams(words, min(SHINGLE, len(words)))
                        keys.append(np.frombuffer(hashlib.blake2b(b" ".join(text.split()), digest_size=16).digest(), "<i8"))
                        bags.append(np.unique(every, return_counts=True))
                        keep.append(k)
                if not keep:
                    continue
                sig = bag_minhash(bags)
                k = np.array(keys)
                rows = batch.take(pa.array(keep))
                bands = band_keys(sig)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(keep) + 1) * bands.shape[1], pa.int32()), pa.array(bands.reshape(-1)))
                yield pa.record_batch([rows.column("row_hash"), rows.column("doc_id").cast(pa.int64()), pa.array(k[:, 0]), pa.array(k[:, 1]), flat, pa.array([x.tobytes() for x in sig.astype(np.uint8)], pa.binary())], ["row_hash", "doc_id", "k1", "k2", "bands", "sig"])

    return docs.select(F.xxhash64("doc_id", "text").alias("row_hash"), "doc_id", "text").mapInArrow(run, "row_hash long, doc_id long, k1 long, k2 long, bands array<long>, sig binary")


@F.pandas_udf(DoubleType())
def agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    """The share of equal components; a byte agrees by chance once in 256, which only lets more pairs through."""
    if not len(a):
        return pd.Series([], dtype=float)
    x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(len(s), -1) for s in (a, b))
    return pd.Series((x == y).mean(axis=1))


def verified(pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) of (a, b, text_a, text_b) whose multisets of shingles overlap enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres: OrderedDict[int, tuple] = OrderedDict()
        for batch in batches:
            good = []
            for k, (key, text_a, text_b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("text_a"), batch.column("text_b"), strict=True)):
                if key not in centres:
                    if len(centres) >= 64:
                        centres.popitem(last=False)
                    centres[key] = shingles(text_a.as_py())
                if overlap(centres[key], shingles(text_b.as_py())) >= similarity:
                    good.append(k)
            yield batch.take(pa.array(good, pa.int64())).select(["a", "b"])

    return stored(pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"), "near-links")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """row_hash, doc_id, class_id, component_id and kept of every document.

    Two texts are linked if the weighted Jaccard similarity of their multisets of five-word shingles is at least similarity;
    a text of fewer words has one shingle. class_id is the least doc_id with the same words, component_id the least
    doc_id that links reach; kept is true for the component's first row, by doc_id (null last) and then by hash. Texts with equal words are
    one class, numbered when the classes are written, and compared once, so groups of copies cost no pairs. Buckets of equal bands are
    not expanded to pairs. Each bucket's most central member (that with the most
    bucket mates) is its centre; every text is verified against the centre whose signature agrees best with its own. Components
    that are still apart, though members share a bucket, are compared in blocks, by signature and then by shingles.
    Null, empty and blank texts have no words: they link with nothing and are kept. component_id is null if all ids of the component are.
    Rows with one doc_id and different words are different documents; rows equal in id and text
    share row_hash and kept. An empty table gives an empty one; other columns are ignored.
    """
    signed = stored(signatures(docs), "near-signatures")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash")
    by_words = signed.groupBy("k1", "k2").agg(F.min("doc_id").alias("class_id"), F.min(order)["row_hash"].alias("giver"))
    by_words = stored(by_words.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    # one row of each class speaks for it; rows equal in id and text are one
    members = signed.join(by_words.select("k1", "k2", "node", F.col("giver").alias("row_hash")), ["k1", "k2", "row_hash"]).select("node", "row_hash", "bands", "sig").dropDuplicates(["node"])
    members = stored(members, "near-members")
    exploded = members.select("node", F.explode("bands").alias("bucket"))
    crowded = stored(exploded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "near-crowded")
    mates = stored(exploded.join(crowded, "bucket"), "near-mates")
    central = mates.groupBy("node").agg(F.sum("n").alias("mates"))
    central = stored(central.join(members, "node").select("node", "row_hash", "mates", "sig"), "near-central")
    least = similarity - SLACK

    now = mates.join(central.select("node", "mates"), "node")
    top = now.groupBy("bucket").agg(F.max(F.struct("mates", "node")).alias("top")).select("bucket", F.col("top.node").alias("a"))
    pairs = mates.join(top, "bucket").where("a <> node").select("a", F.col("node").alias("b")).distinct()
    sig = central.select("node", "sig")
    pairs = pairs.join(sig.withColumnsRenamed({"node": "b", "sig": "sig_b"}), "b").join(sig.withColumnsRenamed({"node": "a", "sig": "sig_a"}), "a")
    pairs = pairs.withColumn("agree", agreement("sig_a", "sig_b")).where(F.col("agree") >= least)
    pairs = stored(pairs.groupBy("b").agg(F.max(F.struct("agree", "a")).alias("best")).select("b", "best.a"), "near-pairs")

    # texts of members, each with the centre to compare it with, and whether it is one
    centres = pairs.select(F.col("a").alias("node")).distinct().withColumn("centre", F.lit(True))
    wanted = central.select("node", "row_hash").join(pairs.withColumnRenamed("b", "node"), "node", "left").join(centres, "node", "left")
    texts = docs.select(F.xxhash64("doc_id", "text").alias("row_hash"), "text").join(wanted, "row_hash").select("node", "a", "centre", "text")
    texts = stored(texts.dropDuplicates(["node"]), "near-texts")
    sides = texts.where("a is not null").select("a", F.col("node").alias("b"), F.col("text").alias("text_b"))
    links = verified(sides.join(texts.where("centre").select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"), similarity)
    comps = _labelled(central, links)
    more = stored(_apart(mates, comps, central, texts, similarity), "near-more")
    if more.take(1):
        comps = _labelled(central, links.unionByName(more))
    discard(members, crowded, mates, texts)

    nodes = by_words.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    nodes = stored(nodes, "near-nodes")
    order = F.struct(F.col("class_id").isNull().alias("no_id"), "class_id", "giver")
    whole = nodes.groupBy("component").agg(F.min("class_id").alias("component_id"), F.min(order)["giver"].alias("first"))
    known = nodes.join(whole, "component").select("k1", "k2", "class_id", "component_id", "first")
    worded = signed.select("row_hash", "doc_id", "k1", "k2").join(known, ["k1", "k2"])
    worded = worded.select("row_hash", "doc_id", "class_id", "component_id", (F.col("row_hash") == F.col("first")).alias("kept"))
    blank = docs.where(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    blank = blank.select(F.xxhash64("doc_id", "text").alias("row_hash"), "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return worded.unionByName(blank)


def _labelled(central: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links, "near-components")
    return stored(central.select("node").join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "near-labels")


def _facing(inside: DataFrame, group: str, size: int) -> DataFrame:
    """(group, block_x, block_y, side, node, component): which members of a group meet in one task.

    Members are cut into blocks of about size, those of a large component apart from others; every two blocks of a group meet in one
    task, but for those of a single component.
    """
    large = inside.groupBy(group, "component").agg(F.count("*").alias("n")).withColumn("large", F.col("n") >= size // 2)
    rest = large.groupBy(group).agg(F.sum(F.when(~F.col("large"), F.col("n")).otherwise(0)).alias("n_rest"))
    shape = large.join(rest, group).withColumn("parts", F.ceil(F.when(F.col("large"), F.col("n")).otherwise(F.col("n_rest")) / size).cast("long"))
    block = F.when(F.col("large"), F.xxhash64("component", F.pmod(F.xxhash64("node"), F.col("parts")))).otherwise(F.pmod(F.xxhash64("component"), F.col("parts")))
    dealt = stored(inside.join(shape.select(group, "component", "large", "parts"), [group, "component"]).select(group, "component", "node", block.alias("block")), "near-dealt")
    spread = dealt.groupBy(group, "block").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
    x, y = (spread.select(group, *(F.col(c).alias(f"{c}_{s}") for c in ("block", "c0", "c1"))) for s in "xy")
    two = stored(x.join(y, group).where("block_x <= block_y and not (c0_x = c1_x and c0_y = c1_y and c0_x = c0_y)").select(group, "block_x", "block_y"), "near-blocks")
    left = two.join(dealt.withColumnRenamed("block", "block_x"), [group, "block_x"]).withColumn("side", F.lit(0))
    right = two.where("block_x <> block_y").join(dealt.withColumnRenamed("block", "block_y"), [group, "block_y"]).withColumn("side", F.lit(1))
    columns = [group, "block_x", "block_y", "side", "node", "component"]
    return left.select(columns).unionByName(right.select(columns))


def _signature_rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _apart(mates: DataFrame, comps: DataFrame, central: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between components that bucket mates hold apart, at least one for each two components that have any.

    1. In every bucket with several components, members of different ones are compared by signature, in blocks. A task gives a forest that
       connects the nodes whose signatures agree enough, not its pairs.
    2. What these forests connect is a family: sharing a bucket by chance does not make one.
    3. Members of a family are compared in blocks, by signature and then by shingles; a task stops for two components at
       their first link.
    """
    least = similarity - SLACK
    held = mates.select("bucket", "node").join(comps, "node")
    mixed = held.groupBy("bucket").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1").select("bucket")
    inside = stored(held.join(mixed, "bucket"), "near-mixed")
    faced = _facing(inside, "bucket", 10 * BLOCK).join(central.select("node", "sig"), "node")

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches, ["bucket", "block_x", "block_y"]):
            sig, side = _signature_rows(rows["sig"]), rows["side"].to_numpy()
            node, comp = rows["node"].to_numpy(), rows["component"].to_numpy()
            a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            b = b if len(b) else a
            root = np.arange(len(node))
            for i in a.tolist():
                others = b[comp[b] != comp[i]]
                near = others[(sig[others] == sig[i]).mean(axis=1) >= least]
                union(root, np.full(len(near), i), near)
            moved = np.flatnonzero(root != np.arange(len(node)))
            yield pa.record_batch([pa.array(node[moved]), pa.array(node[root[moved]])], ["a", "b"])

    keys = ["bucket", "block_x", "block_y"]
    forest = stored(faced.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(agreeing, "a long, b long").distinct(), "near-forest")
    families = components(forest, "near-families").select("node", F.col("component").alias("family"))
    inside = stored(comps.join(families, "node"), "near-inside")
    faced = _facing(inside, "family", BLOCK).join(central.select("node", "sig"), "node").join(texts.select("node", "text"), "node")

    def linked(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        sig, side, text = _signature_rows(rows["sig"]), rows["side"].to_numpy(), rows["text"]
        node, comp = rows["node"].to_numpy(), np.unique(rows["component"].to_numpy(), return_inverse=True)[1]
        root = np.arange(comp.max() + 1)
        bags: dict[int, tuple] = {}
        found: list[tuple[int, int]] = []

        def bag(k: int) -> tuple:
            if k not in bags:
                bags[k] = shingles(text[k].as_py())
            return bags[k]

        a, b = (np.flatnonzero(side == k) for k in (0, 1))
        alone = not len(b)
        b = a if alone else b
        for i in a.tolist():
            others = b[b > i] if alone else b
            agree = (sig[others] == sig[i]).mean(axis=1)
            near = np.flatnonzero(agree >= least)
            for j in others[near[np.argsort(-agree[near], kind="stable")]].tolist():
                if root[comp[i]] != root[comp[j]] and overlap(bag(i), bag(j)) >= similarity:
                    found.append((int(node[i]), int(node[j])))
                    root[root == root[comp[j]]] = root[comp[i]]
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return faced.groupBy("family", "block_x", "block_y").applyInArrow(linked, "a long, b long")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that near_duplicates() keeps, with all their columns; of equal rows one stays."""
    decided = near_duplicates(docs, similarity).where("kept").groupBy("row_hash").agg(F.count("*").alias("times"))
    decided = stored(decided.select(F.col("row_hash").alias("__hash"), F.col("times").alias("__times")), "near-kept")
    rows = docs.withColumn("__hash", F.xxhash64("doc_id", "text")).join(decided, "__hash")
    blank = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    alone = (F.col("__times") == 1) | blank
    return rows.where(alone).unionByName(rows.where(~alone).dropDuplicates(["__hash"])).select(*docs.columns)
