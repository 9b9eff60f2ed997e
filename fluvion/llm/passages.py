"""Removal of repeated passages: recurring phrases are confirmed, compiled to automata and located in all documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import discard, grams, hashes_of_texts, keyed, mix, sliding_min, stored, text_bytes

WINDOW = 35
PHRASE = 11
#: Bytes of text in a block of documents; an automaton serves one block.
BLOCK_BYTES = 6 << 20
#: Phrases in one automaton; a block with more gets several.
SHARD_PHRASES = 50_000
_SECOND = np.uint64(0xA0761D6478BD642F)


class Windows:
    """The windows of a text, or of several of so many words each (sizes), none across two. Each has a phrase, the one of least hash among those in it, so equal windows have equal phrases.

    Neighbouring windows with one phrase form a run, which begins at one of starts and ends before the place in ends.
    """

    def __init__(self, words: np.ndarray, window: int = WINDOW, phrase: int = PHRASE, sizes: list[int] | None = None):
        self.words, self.window, self.phrase_words = words, window, phrase
        self.n = max(0, len(words) - window + 1)
        self.phrases = grams(words, phrase) if self.n else np.zeros(0, np.uint64)
        least = sliding_min(self.phrases, window - phrase + 1) if self.n else np.zeros(0, np.uint64)
        self.text = np.repeat(np.arange(len(sizes or [0])), sizes or [len(words)])  # of each word
        self.at = np.flatnonzero(self.text[: self.n] == self.text[window - 1 :]) if self.n else np.zeros(0, np.int64)
        least = least[self.at]
        self.first = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (np.diff(self.text[self.at]) > 0)))) if len(self.at) else self.at
        self.starts, self.phrase = self.at[self.first], least[self.first]
        self.ends = self.at[np.append(self.first[1:], len(self.at)) - 1] + 1 if len(self.at) else self.at

    def twice(self) -> np.ndarray:
        """Which runs hold their phrase more than once: its first place in the first window is not its last in the last one."""
        inside = self.ends[:, None] - 1 + np.arange(self.window - self.phrase_words, -1, -1)
        last = self.ends - 1 + self.window - self.phrase_words - self.phrases[inside].argmin(axis=1) if len(self.at) else self.starts
        return last != self.phrase_places()

    def phrase_places(self) -> np.ndarray:
        """Where each run's phrase stands first in its first window."""
        inside = self.starts[:, None] + np.arange(self.window - self.phrase_words + 1)
        return self.starts + self.phrases[inside].argmin(axis=1) if len(self.at) else self.starts

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each window."""
        return grams(self.words, self.window), grams(mix(self.words ^ _SECOND), self.window)

    def contexts(self, hashes: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each run's windows: runs with equal ones have equal windows, as often."""
        return tuple(np.add.reduceat(mix(h[self.at]), self.first) if len(self.at) else np.zeros(0, np.uint64) for h in hashes)


def own_repeats(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of hashes in two halves: which occur again, and the places where each occurs first."""
    order = np.lexsort((second, first))
    same = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
    again = np.zeros(len(first), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return again, np.sort(order[np.concatenate(([True], ~same))]) if len(first) else order


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in known, which is sorted."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *(len(v) for v in values)])
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat).cast(kind))


#: Words of short texts whose windows are found in one pass.
TOGETHER = 1 << 14


def _together(texts: list[bytes], window: int, phrase: int) -> Iterator[tuple[int, int, Windows]]:
    """Windows of texts from the first number to before the second, of many short ones at once."""
    held: list[np.ndarray] = []
    at = words = 0
    for k, hashes in enumerate(hashes_of_texts(texts)):
        if held and words + len(hashes) > TOGETHER:
            yield at, k, Windows(np.concatenate(held), window, phrase, [len(h) for h in held])
            at, held, words = k, [], 0
        held.append(hashes)
        words += len(hashes)
    if held:
        yield at, len(texts), Windows(np.concatenate(held), window, phrase, [len(h) for h in held])


def _phrases(batches: Iterator[pa.RecordBatch], window: int, phrase: int) -> Iterator[pa.RecordBatch]:
    """(block, phrase, n): the hash of each run's phrase of each text, 1, and 2 if the run holds it twice."""
    for batch in batches:
        block, hashes, numbers = batch.column(0).to_numpy(), [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        blocks = [block[:0]]
        for at, _, w in _together([text_bytes(t.as_py()) for t in batch.column(1)], window, phrase):
            hashes.append(w.phrase)
            numbers.append(1 + w.twice())
            blocks.append(block[at + w.text[w.starts]])
        yield pa.record_batch([pa.array(np.concatenate(blocks)), pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(numbers).astype(np.int64))], ["block", "phrase", "n"])


def _stretches(text: bytes, hashes: np.ndarray, told: np.ndarray, window: int, phrase: int) -> tuple[list[int], list[str]]:
    """Where a text's windows whose phrase is in told lie: first words and texts of the stretches."""
    w = Windows(hashes, window, phrase)
    hit = np.flatnonzero(among(w.phrase, told))
    if not len(hit):
        return [], []
    words, starts, parts = text.split(), [], []
    for runs in np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1):
        start = int(w.starts[runs[0]])
        starts.append(start)
        parts.append(b" ".join(words[start : int(w.ends[runs[-1]]) - 1 + window]).decode("utf-8", "surrogatepass"))
    return starts, parts


def _runs(batches: Iterator[pa.RecordBatch], window: int, phrase: int) -> Iterator[pa.RecordBatch]:
    """(block, words, c1, c2, n, places) for each run of each stretch: the words of its phrase, its context, 1, and 2 if the run holds the phrase twice."""
    for batch in batches:
        for at in range(0, len(batch), 500):
            blocks, phrases, first, second, places = [], [], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            of, texts = [], []
            for block, parts in zip(batch.column(0)[at : at + 500].to_pylist(), batch.column(1)[at : at + 500].to_pylist(), strict=True):
                texts += [text_bytes(part) for part in parts]
                of += [block] * len(parts)
            for begin, end, w in _together(texts, window, phrase):
                words = [word for data in texts[begin:end] for word in data.split()]
                c1, c2 = w.contexts(w.hashes())
                first.append(c1)
                second.append(c2)
                places.append(1 + w.twice())
                phrases += [b" ".join(words[p : p + phrase]).decode("utf-8", "surrogatepass") for p in w.phrase_places().tolist()]
                blocks += [of[begin + t] for t in w.text[w.starts].tolist()]
            c1, c2 = (pa.array(np.concatenate(x).view(np.int64)) for x in (first, second))
            yield pa.record_batch([pa.array(blocks, pa.int32()), pa.array(phrases, pa.string()), c1, c2, pa.array(np.ones(len(blocks), np.int64)), pa.array(np.concatenate(places).astype(np.int64))], ["block", "words", "c1", "c2", "n", "places"])


class Automata:
    """Sharded Aho-Corasick automata over confirmed phrases; a match is a whole-word one."""

    def __init__(self, phrases: list[str], shard: int = SHARD_PHRASES):
        import ahocorasick

        self.shards = []
        for at in range(0, len(phrases), shard):
            automaton = ahocorasick.Automaton()
            for k, words in enumerate(phrases[at : at + shard]):
                automaton.add_word(f" {words} ", (at + k, len(words)))
            automaton.make_automaton()
            self.shards.append(automaton)

    def matches(self, text: str, n_words: int) -> np.ndarray:
        """Of text, words joined by single spaces: the phrase that starts at each word, or -1. Phrases have equally many words, so there is one at most."""
        out = np.full(n_words, -1, np.int64)
        found = [(end - length - 1, k) for automaton in self.shards for end, (k, length) in automaton.iter(f" {text} ")]
        if found:
            space = np.flatnonzero(np.frombuffer(f" {text}".encode("utf-32-le", "surrogatepass"), "<u4") == 32)
            begin, k = np.array(found, np.int64).T
            out[np.searchsorted(space, begin)] = k
        return out


def _settle(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table, window: int, phrase: int) -> pa.Table:
    """What a block's automata find in its stretches: covered words (from, to), windows to ask for and windows given out."""
    told = right["told"].combine_chunks().flatten() if len(right) else None
    dictionary = told.field("words").dictionary_encode() if told is not None else pa.array([], pa.string()).dictionary_encode()
    automata = Automata(dictionary.dictionary.to_pylist())
    known: dict[tuple[int, int, int], int] = {}
    settled, gives = np.zeros(0, bool), np.zeros(0, bool)
    if told is not None:
        known = {run: k for k, run in enumerate(zip(dictionary.indices.to_pylist(), told.field("c1").to_pylist(), told.field("c2").to_pylist(), strict=True))}
        settled, gives = (told.field(k).to_numpy(zero_copy_only=False).astype(bool) for k in ("settled", "gives"))
    gave = np.zeros(len(settled), bool)
    none, out = np.zeros(0, np.int64), {n: [] for n in ("froms", "tos", "places", "w1", "w2", "g1", "g2")}
    every = left["parts"].to_pylist()
    hashed = hashes_of_texts(text_bytes(part) for parts in every for part in parts)
    for starts, parts in zip(left["starts"].to_pylist(), every, strict=True):
        seen, full, asks, given = [], [none], [none], [(none.view(np.uint64),) * 2]
        for start, part in zip(starts, parts, strict=True):
            w = Windows(next(hashed), window, phrase)
            phrase_at = automata.matches(part, len(w.words))[w.phrase_places()]
            hit = np.flatnonzero(phrase_at >= 0)
            if not len(hit):
                continue
            hashes = w.hashes()
            c1, c2 = (c[hit].view(np.int64).tolist() for c in w.contexts(hashes))
            k = np.array([known[run] for run in zip(phrase_at[hit].tolist(), c1, c2, strict=True)])
            lengths = w.ends[hit] - w.starts[hit]
            windows = np.repeat(w.starts[hit] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            seen.append((start + windows, *(h[windows] for h in hashes)))
            full.append(start + windows[np.repeat(settled[k], lengths)])
            asks.append(start + windows[np.repeat(~settled[k] & gives[k], lengths)])
            for run, one in zip(hit[settled[k] & gives[k]].tolist(), k[settled[k] & gives[k]].tolist(), strict=True):
                if not gave[one]:
                    gave[one] = True
                    given.append(tuple(h[w.starts[run] : w.ends[run]] for h in hashes))
        places, h1, h2 = (np.concatenate(x) for x in zip(*seen, strict=True)) if seen else (none, *given[0])
        again, firsts = own_repeats(h1, h2)
        covered = np.unique(np.concatenate([*full, places[again]]))
        gaps = np.flatnonzero(np.diff(covered) > window)
        out["froms"].append(covered[np.concatenate(([0], gaps + 1))] if len(covered) else none)
        out["tos"].append(covered[np.concatenate((gaps, [len(covered) - 1]))] + window if len(covered) else none)
        ask = firsts[np.isin(places[firsts], np.concatenate(asks))]  # a window once for each document
        for name, value in zip(("places", "w1", "w2"), (places, h1, h2), strict=True):
            out[name].append(value[ask])
        for name, value in zip(("g1", "g2"), zip(*given, strict=True), strict=True):
            out[name].append(np.concatenate(value))
    lists = {n: _lists(v, pa.int32() if n in ("froms", "tos", "places") else pa.int64()) for n, v in out.items()}
    return pa.table({"row": left["row"].combine_chunks(), **lists})


def remove_passages(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of docs, with n_words, n_removed and kept (the kept words, joined by one space).

    Each word goes that lies in a window of window words whose word sequence also starts anywhere else in docs, the same
    document included. All decisions are made on the input.

    1. Screen. Every text gives the hashes of its phrases (see Windows). Documents are dealt to blocks by their places in the input; a block
       learns which of its phrase hashes docs have twice, and gives the stretches of text whose windows have such a phrase.
    2. Confirm. The stretches' phrases are counted by their words, over all blocks; so are runs, by phrase and context.
    3. Locate. A block's confirmed phrases are compiled to sharded automata that stream its stretches. Windows are examined only
       where the automata match. Runs whose whole context occurs twice are repeated in all their windows; of the others the windows
       are given out as 128-bit hashes, and counted over all documents, a whole context giving its windows once.
    4. Windows counted twice are joined back to the documents that asked for them, and the words they cover go.

    A null or empty text has no words, nothing is removed from texts shorter than a window that repeats no window, repeated
    rows are copies of each other, an empty table gives an empty one. Clashing columns (n_words, n_removed, kept) are replaced.
    Words are told apart by 64 bits, sequences of them by 128.
    """
    docs = docs.drop("n_words", "n_removed", "kept")
    names = docs.columns
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 32)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = keyed(docs, "__key").withColumn("__block", F.pmod("__key", F.lit(blocks)).cast("int")).drop("__key")

    phrases = dealt.select("__block", "text").mapInArrow(lambda b: _phrases(b, window, phrase), "block int, phrase long, n long")
    phrases = stored(phrases.groupBy("block", "phrase").agg(F.sum("n").alias("n")), "passages-phrases")
    often = phrases.groupBy("phrase").agg(F.sum("n").alias("n_phrase")).where("n_phrase > 1").select("phrase")
    told = phrases.join(often, "phrase").groupBy(F.col("block").alias("__block")).agg(F.collect_list("phrase").alias("told"))  # bounded by the block

    def cut(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        known = np.sort(right["told"].combine_chunks().flatten().to_numpy().view(np.uint64)) if len(right) else np.zeros(0, np.uint64)
        hashes = hashes_of_texts(text_bytes(t.as_py()) for t in left["text"])
        found = [_stretches(text_bytes(t.as_py()), h, known, window, phrase) for t, h in zip(left["text"], hashes, strict=True)]
        for name, kind, k in (("__starts", pa.int32(), 0), ("__parts", pa.string(), 1)):
            left = left.append_column(name, pa.array([f[k] for f in found], pa.list_(kind)))
        return left

    inner = StructType([*docs.schema.fields, StructField("__block", IntegerType()), StructField("__starts", ArrayType(IntegerType())), StructField("__parts", ArrayType(StringType()))])
    screened = dealt.groupBy("__block").cogroup(told.groupBy("__block")).applyInArrow(cut, inner)
    rows = stored(screened.withColumn("__row", F.monotonically_increasing_id()), "passages-screened")  # numbers are fixed by the write
    discard(phrases)

    stretches = rows.where(F.size("__parts") > 0).select(F.col("__row").alias("row"), F.col("__block").alias("block"), F.col("__starts").alias("starts"), F.col("__parts").alias("parts"))
    runs = stretches.select("block", "parts").mapInArrow(lambda b: _runs(b, window, phrase), "block int, words string, c1 long, c2 long, n long, places long")
    runs = stored(runs.groupBy("block", "words", "c1", "c2").agg(F.sum("n").alias("n"), F.sum("places").alias("places")), "passages-runs")
    confirmed = runs.groupBy("words").agg(F.sum("n").alias("n_phrase"), F.sum("places").alias("places")).where("places > 1").select("words", "n_phrase")
    whole = runs.groupBy("words", "c1", "c2").agg(F.sum("n").alias("n_context"), F.min("block").alias("giver"))
    # settled: the whole context occurs again. gives: its windows must be counted, from one block if it is settled
    gives = (F.col("n_context") < F.col("n_phrase")) & ((F.col("n_context") == 1) | (F.col("giver") == F.col("block")))
    told = runs.join(confirmed, "words").join(whole, ["words", "c1", "c2"]).select("block", "words", "c1", "c2", (F.col("n_context") > 1).alias("settled"), gives.alias("gives"))
    told = told.groupBy("block").agg(F.collect_list(F.struct("words", "c1", "c2", "settled", "gives")).alias("told"))  # bounded by the block

    def settle(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        return _settle(key, left, right, window, phrase)

    located = stretches.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(settle, "row long, froms array<int>, tos array<int>, places array<int>, w1 array<long>, w2 array<long>, g1 array<long>, g2 array<long>")
    located = stored(located, "passages-located")
    discard(runs)
    asked = located.select("row", F.explode(F.arrays_zip("places", "w1", "w2")).alias("w")).select("row", "w.places", "w.w1", "w.w2")
    # a window of a whole context that occurs again counts as two, whatever else it meets
    given = located.select(F.explode(F.arrays_zip("g1", "g2")).alias("w")).select(F.col("w.g1").alias("w1"), F.col("w.g2").alias("w2"), F.lit(2).cast("long").alias("n"))
    votes = asked.groupBy("w1", "w2").agg(F.count("*").alias("n")).unionByName(given)
    again = votes.groupBy("w1", "w2").agg(F.sum("n").alias("n")).where("n > 1").select("w1", "w2")
    found = asked.join(again, ["w1", "w2"]).groupBy("row").agg(F.collect_list("places").alias("__again"))  # bounded by the text's own windows
    cover = located.select("row", F.col("froms").alias("__froms"), F.col("tos").alias("__tos")).join(found, "row", "left").withColumnRenamed("row", "__row")
    held = rows.where(F.size("__parts") > 0).join(stored(cover, "passages-cover"), "__row", "left")
    free = rows.where(F.size("__parts") == 0)
    schema = StructType([*docs.schema.fields, StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, len(whole_batch), 500):
                batch = whole_batch.slice(at, 500)
                kept, n_words, n_removed = [], [], []
                for text, froms, tos, back in zip(*(batch.column(n) for n in ("text", "__froms", "__tos", "__again")), strict=True):
                    words = text_bytes(text.as_py()).split()
                    step = np.zeros(len(words) + 1, np.int64)
                    if froms.is_valid:
                        step[froms.values.to_numpy()] += 1  # these ranges don't touch
                        step[tos.values.to_numpy()] -= 1
                    if back.is_valid:
                        places = back.values.to_numpy()
                        np.add.at(step, places, 1)
                        np.add.at(step, places + window, -1)
                    covered = np.cumsum(step[:-1]) > 0
                    gone = int(covered.sum())
                    n_words.append(len(words))
                    n_removed.append(gone)
                    kept.append(b" ".join(w for w, c in zip(words, covered.tolist(), strict=True) if not c) if gone else b" ".join(words))
                yield pa.record_batch([*(batch.column(n) for n in names), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string())], [*names, "n_words", "n_removed", "kept"])

    columns = [*names, "__froms", "__tos", "__again"]
    none = {n: F.lit(None).cast("array<int>") for n in columns[-3:]}
    return held.select(columns).unionByName(free.withColumns(none).select(columns)).mapInArrow(finish, schema)


def digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words."""
    return removed.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def brute_force(texts: list[str | None], window: int = WINDOW) -> list[tuple[int, int, str]]:
    """(n_words, n_removed, kept_sha256) by counting every window; for tests."""
    from collections import Counter

    split = [text_bytes(t).split() for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = True
        out.append((len(w), int(gone.sum()), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return out
