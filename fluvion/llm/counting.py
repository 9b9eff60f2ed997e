"""Exact token counts by rank-synchronous merging of ragged arrays of pre-tokens."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_bytes
from .tokens import vocabulary as path_of

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
#: Counts of so many pre-tokens are remembered in a task.
REMEMBER = 400_000
#: Bytes of text whose new pre-tokens are merged together.
TOGETHER = 4 << 20
#: After so many rounds what is left is finished one sequence at a time.
ROUNDS = 400
NONE = np.iinfo(np.int64).max
#: The library's sign for a space.
BLANK = "▁"


class Merger:
    """The merges of a sentencepiece BPE vocabulary with byte fallback, as arrays."""

    def __init__(self, file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=file)
        normal = [i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        pieces = {model.id_to_piece(i): i for i in normal}
        scores = np.array([model.get_score(i) for i in range(model.vocab_size())])
        self.unknown = self.base = model.vocab_size()
        if any(model.is_unused(i) for i in normal) or any(c not in pieces for p in pieces for c in p):
            raise ValueError("a vocabulary with unused pieces, or with pieces of unknown characters, isn't supported")
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a vocabulary whose pieces span words isn't supported")
        self.symbol_of = np.full(0x110000, self.unknown, np.int64)
        for p, i in pieces.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        self.symbol_of[32] = pieces[BLANK]
        self.base += 1
        rank = np.unique(-scores, return_inverse=True)[1]
        pairs = {(pieces[p[:k]], pieces[p[k:]]): i for p, i in pieces.items() for k in range(1, len(p)) if p[:k] in pieces and p[k:] in pieces}
        keys = np.array([a * self.base + b for a, b in pairs], np.int64)
        merged = np.array(list(pairs.values()), np.int64)
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], merged[order]
        self.ranks = rank[self.merged].astype(np.int64)
        breaks = "".join(c for c in "\n\t\r" if self.symbol_of[ord(c)] == self.unknown)
        #: A pre-token: blanks and what follows up to the next blank, or a character that no piece holds.
        self.pattern = re.compile(rf" *[^ {breaks}]+| +|[{breaks}]" if breaks else r" *[^ ]+| +")

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        found = self.keys[at] == wanted
        return np.where(found, self.ranks[at], NONE), self.merged[at]

    def pairs(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each symbol the rank and result of merging it with the next one of its sequence."""
        rank, result = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int64)
        same = np.flatnonzero(owner[1:] == owner[:-1])
        rank[same], result[same] = self.lookup(symbols[same], symbols[same + 1])
        return rank, result

    def counts(self, tokens: list[str]) -> np.ndarray:
        """Symbols that survive for each pre-token; an unknown character counts as its UTF-8 bytes.

        In every round each sequence merges its lowest-ranked pair, all sequences at once: all its places, from the left, if
        no pair that comes into being ranks as low, else only the leftmost. That is the order in which the library merges.
        """
        total = np.zeros(len(tokens), np.int64)
        if not tokens:
            return total
        lengths = np.array([len(t) for t in tokens])
        codes = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(tokens)), lengths)
        symbols = self.symbol_of[codes]
        strange = np.flatnonzero(symbols == self.unknown)
        wide = 1 + (codes[strange] > 0x7F) + (codes[strange] > 0x7FF) + (codes[strange] > 0xFFFF)
        np.add.at(total, owner[strange], wide - 1)
        rank, result = self.pairs(symbols, owner)
        for _ in range(ROUNDS):
            lowest = np.full(len(tokens), NONE)
            np.minimum.at(lowest, owner, rank)
            done = lowest[owner] == NONE
            if done.any():
                np.add.at(total, owner[done], 1)
                keep = ~done
                symbols, owner, rank, result = symbols[keep], owner[keep], rank[keep], result[keep]
            if not len(symbols):
                return total
            here = rank == lowest[owner]
            chosen = self._alternate(here, owner)
            state = self._merge(symbols, owner, result, chosen)
            low = lowest[state[1]]
            fresh = state[4]
            touched = fresh & (state[2] <= low)
            touched[:-1] |= fresh[1:] & (state[2][:-1] <= low[:-1])
            if touched.any():
                single = np.zeros(len(tokens), bool)
                single[state[1][touched]] = True
                first = chosen & ~np.concatenate(([False], (np.cumsum(chosen)[:-1] - self._before(chosen, owner)[1:]) > 0))
                chosen = np.where(single[owner], first, chosen)
                state = self._merge(symbols, owner, result, chosen)
            symbols, owner, rank, result, _ = state
        for k in np.unique(owner):
            total[k] += self.one(symbols[owner == k].tolist())
        return total

    @staticmethod
    def _before(chosen: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """How many are chosen before each symbol's sequence."""
        start = np.concatenate(([True], owner[1:] != owner[:-1]))
        count = np.concatenate(([0], np.cumsum(chosen)[:-1]))
        return np.maximum.accumulate(np.where(start, count, 0))

    @staticmethod
    def _alternate(here: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Of neighbouring places that overlap, every other one from the left."""
        start = here & ~np.concatenate(([False], here[:-1] & (owner[1:] == owner[:-1])))
        place = np.arange(len(here))
        return here & ((place - np.maximum.accumulate(np.where(start, place, 0))) % 2 == 0)

    def _merge(self, symbols, owner, result, chosen):
        symbols = np.where(chosen, result, symbols)
        keep = ~np.concatenate(([False], chosen[:-1]))
        symbols, owner, fresh = symbols[keep], owner[keep], chosen[keep]
        return symbols, owner, *self.pairs(symbols, owner), fresh

    def one(self, symbols: list[int]) -> int:
        """The same for one sequence with a heap, for the few that need very many rounds."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(places: list[int]) -> None:
            places = [p for p in places if p >= 0 and after[p] < n]
            if places:
                left, right = np.array([symbols[p] for p in places]), np.array([symbols[after[p]] for p in places])
                for p, r, m in zip(places, *(x.tolist() for x in self.lookup(left, right)), strict=True):
                    if r != NONE:
                        heapq.heappush(heap, (r, p, symbols[p], symbols[after[p]], m))

        offer(list(range(n - 1)))
        left = n
        while heap:
            _, p, a, b, m = heapq.heappop(heap)
            if symbols[p] != a or after[p] >= n or symbols[after[p]] != b:
                continue
            gone = after[p]
            symbols[p], symbols[gone], after[p] = m, -1, after[gone]
            if after[gone] < n:
                before[after[gone]] = p
            left -= 1
            offer([before[p], p])
        return left


@lru_cache(maxsize=2)
def merger(vocabulary: str) -> Merger:
    return Merger(path_of(vocabulary))


def count_texts(texts: list[str], merges: Merger, known: dict[str, int]) -> list[int]:
    """Tokens of each text. known remembers pre-tokens."""
    # the library puts one blank before a text that isn't empty
    split = [merges.pattern.findall(" " + t.replace(BLANK, " ")) if t else [] for t in texts]
    new = list({w for words in split for w in words if w not in known})
    if len(known) + len(new) > REMEMBER:
        known.clear()
        new = list({w for words in split for w in words})
    known.update(zip(new, merges.counts(new).tolist(), strict=True))
    out = [sum(map(known.__getitem__, words)) for words in split]
    if len(known) > REMEMBER:
        known.clear()
    return out


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of each document's whole text.

    No begin, end or other tokens are added; control strings within texts are ordinary text, as the library has it. A
    null text is an empty one and has no tokens. Rows are counted one by one, so equal rows give equal rows; an
    empty table gives an empty one; other columns of docs are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, known = merger(vocabulary), {}
        for batch in batches:
            texts, at = [x or "" for x in batch.column(1).to_pylist()], 0
            sizes = [len(text_bytes(t)) for t in texts]
            counted: list[int] = []
            while at < len(texts):
                end, much = at, 0
                while end < len(texts) and (end == at or much + sizes[end] <= TOGETHER):
                    much += sizes[end]
                    end += 1
                counted += count_texts(texts[at:end], merges, known)
                at = end
            yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(counted, pa.int64()), pa.array([n > limit for n in counted], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
