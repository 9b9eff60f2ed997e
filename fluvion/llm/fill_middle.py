"""Fill-in-middle: documents are cut at two seeded token borders and their parts reordered, by an index of distinct texts."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, keyed, text_bytes

SEED = 42
#: Of 100 documents so many are reordered, and of 100 of these so many begin with the suffix.
RATE, SUFFIX_FIRST = 50, 80
#: Signs that begin the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
#: Copies of a text that one entry of the index serves; a text with more gets an entry for each so many of them.
COPIES = 256
#: Texts with more copies than one entry serves are broadcast: never more than this many, as beyond it an entry serves more copies.
HOT_TEXTS = 10_000

_ONES = np.array([bin(b).count("1") for b in range(256)], np.int64)


class EliasFano:
    """A rising list of integers below or equal to chars: low bits packed, high bits in unary; some two bits and the low ones for each."""

    def __init__(self, n: int, chars: int, low: bytes, high: bytes):
        self.n, self.chars, self.low, self.high = n, chars, low, high

    @property
    def width(self) -> int:
        return max(0, math.floor(math.log2(self.chars / self.n))) if self.n and self.chars > self.n else 0

    @classmethod
    def of(cls, values: np.ndarray, chars: int) -> EliasFano:
        out = cls(len(values), chars, b"", b"")
        if not len(values):
            return out
        values, width = values.astype(np.int64), out.width
        if width:
            bits = (values[:, None] >> np.arange(width)) & 1
            out.low = np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little").tobytes()
        high = np.zeros((chars >> width) + len(values) + 1, np.uint8)
        high[(values >> width) + np.arange(len(values))] = 1
        out.high = np.packbits(high, bitorder="little").tobytes()
        return out

    def __getitem__(self, k: int) -> int:
        """The k-th value, by the place of the k-th one among the high bits."""
        if not 0 <= k < self.n:
            raise IndexError(k)
        high = np.frombuffer(self.high, np.uint8)
        before = np.cumsum(_ONES[high])
        byte = int(np.searchsorted(before, k, side="right"))
        rest = k - (int(before[byte - 1]) if byte else 0)
        bit = int(np.flatnonzero(np.unpackbits(high[byte : byte + 1], bitorder="little"))[rest])
        value, width = (byte * 8 + bit - k), self.width
        if not width:
            return value
        first = k * width
        piece = int.from_bytes(self.low[first // 8 : (first + width + 7) // 8], "little") >> (first % 8)
        return value << width | (piece & ((1 << width) - 1))


def boundaries(text: str) -> np.ndarray:
    """Where tokens end, in code points: at the end of each word, and at the text's end if it ends with blanks."""
    data = np.frombuffer(text_bytes(text), np.uint8)
    if not len(data):
        return np.zeros(0, np.int64)
    inside = ~SPACE[data]
    ends = np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1
    if not inside[-1]:
        ends = np.append(ends, len(data))
    return np.cumsum((data & 0xC0) != 0x80)[ends - 1]


class TextIndex:
    """The distinct texts of one hash with their boundaries; a text is looked up by its contents, so a shared hash mixes up nothing."""

    def __init__(self) -> None:
        self.entries: list[tuple[str, EliasFano]] = []

    def find(self, text: str) -> EliasFano:
        for known, found in self.entries:
            if known == text:
                return found
        self.entries.append((text, EliasFano.of(boundaries(text), len(text))))
        return self.entries[-1][1]


def cut(doc_id: int | None, text: str, index: EliasFano, seed: int = SEED) -> tuple[str, int | None, int | None, str]:
    """form, prefix_chars, middle_chars and output of a document."""
    drawn = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or h3 % 100 >= RATE or any(m in text for m in MARKS):
        return "plain", None, None, text
    first, second = sorted((h1 % (index.n + 1), h2 % (index.n + 1)))
    a, b = (index[k - 1] if k else 0 for k in (first, second))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = MARKS
    if h4 % 100 < SUFFIX_FIRST:
        return "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that output was made of: only marks that were put in stand there unless form is plain."""
    output, form = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    parts = F.split(output, "|".join(MARKS), -1)
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    out = F.when(form == "plain", output)
    for name, places in order.items():
        out = out.when(form == name, F.concat(*(parts.getItem(k) for k in places)))
    return out


def keyed_texts(docs: DataFrame, copies: int = COPIES) -> DataFrame:
    """docs with text (null: empty), h1 and h2 (its hash), and share: which of its entries serves the row.

    Texts with more than copies rows are counted by their hashes first, and their rows are dealt to entries by a hash of doc_id and a random draw
    of fixed seed, so that no text's rows meet in one place.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = keyed(docs.select("doc_id", text.alias("text")), "row_key").withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit("second"), "text")})
    counted = rows.groupBy("h1", "h2").agg(F.count("*").alias("n"))
    many = max(copies, docs.count() // HOT_TEXTS)
    hot = counted.where(F.col("n") > many).select("h1", "h2", F.ceil(F.col("n") / many).cast("int").alias("shares"))
    # at most HOT_TEXTS rows: more texts can't have so many copies each
    rows = rows.join(F.broadcast(hot), ["h1", "h2"], "left")
    share = F.coalesce(F.pmod("row_key", F.col("shares")), F.lit(0)).cast("int")
    return rows.select("doc_id", "text", "h1", "h2", share.alias("share"))


def fill_in_middle(docs: DataFrame, seed: int = SEED, copies: int = COPIES) -> DataFrame:
    """doc_id, n (tokens of the text), form (plain, psm or spm), prefix_chars, middle_chars (code points; null if plain) and output of every document.

    A token is a word with the blanks before it, or the blanks at a text's end. The rows are dealt and sorted by a hash of their texts, which joins
    the documents of a text to its entry in the index: the entry is made where the text, compared by its contents, comes up first, as an
    Elias-Fano list of the tokens' borders, and serves the rows that follow. Each document's seeded cut is two lookups in it.
    A text's entry is made once, or once for each so many copies, so that a text of a third of all rows is dealt to many tasks. A
    task holds one text and its list at a time; every text goes through one shuffle.
    Null and empty texts have no tokens and are plain with an empty output, as are texts that contain a mark. A null doc_id draws as the
    word null. Equal rows give equal rows; an empty table gives an empty one; other columns are ignored.
    """
    rows = keyed_texts(docs, copies).repartition("h1", "h2", "share").sortWithinPartitions("h1", "h2")
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, index = None, TextIndex()
        for whole in batches:
            for at in range(0, len(whole), 200):
                batch = whole.slice(at, 200)
                ids, out = batch.column("doc_id").to_pylist(), []
                for doc_id, text, h1, h2 in zip(ids, batch.column("text").to_pylist(), batch.column("h1").to_pylist(), batch.column("h2").to_pylist(), strict=True):
                    if (h1, h2) != here:
                        here, index = (h1, h2), TextIndex()
                    found = index.find(text)
                    out.append((found.n, *cut(doc_id, text, found, seed)))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_string())
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                columns[-1] = columns[-1].cast(pa.string())
                yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), *columns], names)

    return rows.select("doc_id", "text", "h1", "h2").mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")
