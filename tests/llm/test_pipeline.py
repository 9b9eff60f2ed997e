"""The rows of every stage of the pipeline against independent versions in plain Python and SQL, each judged on its own input."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from fluvion.llm import common, passages, queries, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(77)
    out = [(i, prose(i, r.randint(40, 120)) + (" zlorg vexum grimp " if i % 9 == 0 else " ") + prose(i + 5000, 20), "en", f"s{i % 4}", None) for i in range(260)]
    shared = prose(999, 70)
    out += [(1000 + k, f"{prose(k + 8000, 30)}\n{shared}\t{prose(k + 9000, 25)}", "de", "s1", None) for k in range(6)]
    for k in range(5):  # near copies, and exact ones
        base = prose(300 + k, 150).split()
        for m in range(4):
            t = base.copy()
            if m:
                t[10 * m] = f"changed{m}"
            out.append((2000 + 10 * k + m, " ".join(t), "en", "s2", None))
    out += [(3000, None, None, None, None), (3001, "", "en", None, None), (3002, " \n ", "en", "s0", None), (3003, prose(1, 30), None, "s3", None), (3003, prose(1, 30), None, "s3", None), (None, prose(2, 35), "fr", "s3", None)]
    return [(d, t, lang, s, None if t is None else len(t)) for d, t, lang, s, _ in out]


def plain(df):
    return Counter(tuple(r) for r in df.collect())


def near_components(given):
    """Component of each row, by the weighted Jaccard similarity of multisets of five-word runs."""
    def bag(text):
        words = (text or "").split()
        return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()

    bags = [bag(t) for _, t, *_ in given]
    parent = list(range(len(given)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(given)):
        for j in range(i):
            if bags[i] and bags[j] and (bags[i] & bags[j]).total() >= 0.8 * (bags[i] | bags[j]).total():
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(given))]


def test_every_stage_keeps_to_its_rule(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 7 > 0), int(i % 9 == 0)) for i in range(260)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    given, steps = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, given, str(tmp_path)), f"check-{name.replace(' ', '-')}")
        steps[name] = (given.collect(), out)
        given = out

    before, after = steps["toxicity"]
    kept = plain(after)
    gone = Counter(tuple(r) for r in before) - kept
    assert not kept - Counter(tuple(r) for r in before)
    assert all("zlorg" in r[1] for r in gone) and sum("zlorg" in (r.text or "") for r in after.collect()) <= 1

    before, after = steps["near duplicates"]
    comps = near_components(before)
    kept = plain(after)
    assert not kept - Counter(tuple(r) for r in before)
    groups = {}
    for r, k in zip(before, comps, strict=True):
        groups.setdefault(k, []).append(r)
    want = Counter()
    for members in groups.values():
        least = min((r.doc_id is None, r.doc_id or 0) for r in members)
        best = [tuple(r) for r in members if (r.doc_id is None, r.doc_id or 0) == least]
        found = [b for b in dict.fromkeys(best) if kept[b]]
        assert len(found) == 1  # one document of each group stays, by the least id
        want[found[0]] += 1
    assert kept == want

    before, after = steps["passages"]
    brute = passages.brute_force([r.text for r in before])
    done = {(r.doc_id, r.source, r.lang): r for r in after.collect()}
    assert after.count() == len(before) and sum(n for _, n, _ in brute) > 300
    for r, (_, n, digest) in zip(before, brute, strict=True):
        now = done[r.doc_id, r.source, r.lang]
        if n:
            import hashlib

            assert hashlib.sha256(now.text.encode()).hexdigest() == digest and now.n_chars == len(now.text)
        else:
            assert (now.text, now.n_chars) == (r.text, r.n_chars)

    before, after = steps["mixing"]
    c = duckdb.connect()
    c.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    c.executemany("insert into documents values (?, ?, ?, ?, ?)", [tuple(r) for r in before])
    taken = {d: (size, t) for d, size, _, _, t in c.execute(queries.SQL["op2_mix_sources"]).fetchall()}
    copies = Counter(r.doc_id for r in after.collect())
    assert all(copies[d] * size == t for d, (size, t) in taken.items() if size)
    assert not set(plain(after)) - {tuple(r) for r in before}

    before, after = steps["packing"]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.vocabulary("byte_bpe_50k.json"))
    want = Counter()
    for r in before:
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        starts = [0, *range(first, len(ids), 1024)] if len(ids) > 1024 else [0]
        for k, (i, j) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[r.doc_id, k, i, j - i, zlib.crc32(ids[i:j].tobytes())] += 1
    got = after.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    ends = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 1024

    whole = corpus_pipeline.run(spark, str(tmp_path))
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole.collect())) == sorted(map(key, got))
    assert whole.columns == after.columns


def test_extra_columns_pass_through_the_stages(spark, rows, tmp_path):
    """Columns with the operators' own names are documents' columns to the stages: all but the last give them back."""
    docs = spark.createDataFrame(rows[:60], SCHEMA)
    from pyspark.sql import functions as F

    for name in ("kept", "n_words", "n_removed", "row_hash", "copies", "size", "rejected", "p_toxic", "target"):
        docs = docs.withColumn(name, F.lit("mine"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        lost = [c for c in docs.columns if c not in out.columns]
        assert not lost, (name, lost)
