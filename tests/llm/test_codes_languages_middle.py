"""op11 to op13 against brute force, the library's own round trips and held-out accuracy, and on awkward tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyspark.sql.functions as F
import pytest

from fluvion.llm import codes, fill_middle, languages

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["h1", "h2", "share", "row_key", "n", "form", "output", "score", "lang_pred", "rejected", "q", "code", "error", "entry", "h", "rank", "copies"]
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def clashing(df):
    for name in CLASHES:
        df = df.withColumn(name, F.lit("mine"))
    return df


# op12


def quantised(v):
    return [int(np.floor(np.float64(x) * 256)) for x in v]


def brute_codes(rows, parts=16, entries=64, rounds=2):
    """(vec_id, label, code, error) of rows (vec_id, vector, label) of one length, and the codebooks' digest, in plain integers."""
    q = {k: quantised(v) for k, (_, v, _) in enumerate(rows)}
    wide = len(q[0]) // parts
    order = sorted(q, key=lambda k: (rows[k][0] is None, rows[k][0] or 0, q[k]))[:entries]
    books = [[q[k][p * wide : p * wide + wide] for k in order] for p in range(parts)]

    def nearest(k, p):
        part = q[k][p * wide : p * wide + wide]
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        assigned = {(k, p): nearest(k, p)[1] for k in q for p in range(parts)}
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [q[k][p * wide : p * wide + wide] for k in q if assigned[k, p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = []
    for k in q:
        found = [nearest(k, p) for p in range(parts)]
        out.append((rows[k][0], rows[k][2], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def test_op12_tree_gives_the_nearest_entry_of_the_lowest_index():
    rng = np.random.default_rng(0)
    for entries, spread, wide in ((1, 9, 4), (6, 9, 1), (64, 3, 2), (64, 400, 4), (200, 30, 3), (256, 1 << 23, 5)):
        e = rng.integers(-spread, spread + 1, (entries, wide))
        x = np.concatenate([rng.integers(-spread, spread + 1, (3000, wide)), e])
        tree = codes.VantageTree(e)
        at, square = tree.nearest(x)
        d = ((x[:, None, :] - e[None]) ** 2).sum(axis=2)
        assert (at == d.argmin(axis=1)).all() and (square == d.min(axis=1)).all()
    # points near their entries: most entries are never looked at
    e = rng.integers(-4000, 4000, (256, 3))
    tree = codes.VantageTree(e)
    tree.nearest(e[rng.integers(0, 256, 5000)] + rng.integers(-20, 20, (5000, 3)))
    assert tree.visited < 5000 * 256 / 4


def test_op12_roots_are_rounded_away():
    s = np.array([0, 1, 2, 3, 4, 8, 9, 10, (1 << 28) ** 2 - 1, (1 << 28) ** 2, (1 << 28) ** 2 + 1], np.int64)
    down, up = codes.root_down(s), codes.root_up(s)
    assert all(d * d <= x < (d + 1) ** 2 and (u - 1) ** 2 < x <= u * u or x == 0 for x, d, u in zip(s.tolist(), down.tolist(), up.tolist(), strict=True))


def test_op12_equals_brute_force(spark):
    r = random.Random(5)
    rows = [(i - 20, [r.gauss(0, 0.3) for _ in range(32)], i % 3 or None) for i in range(150)]
    rows += [(7, rows[3][1], 1), (7, rows[3][1], 1), (None, rows[9][1], 2), (400, [-0.001] * 32, 5), (401, [0.0] * 32, 5)]
    awkward = [(500, None, 1), (501, [0.1, None] * 16, 1), (502, [float("nan")] * 32, 2), (503, [float("inf")] * 32, None), (504, [], 1), (505, [1.0] * 16, 77), (506, [1.0] * 31, 78), (507, [1e30] * 32, 79)]
    given = clashing(spark.createDataFrame(rows + awkward, "vec_id long, embedding array<double>, label int")).repartition(5)
    got = codes.compress(given).collect()
    want, digest = brute_codes(rows)
    errors = {}
    for _, label, _, error in want:
        errors[label] = errors.get(label, 0) + error
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((x.vec_id, x.label, x.code, x.error) for x in got if x.code), key=key) == sorted(want, key=key)
    assert {x.codebooks_sha256 for x in got} == {digest}
    assert all(x.label_error == errors.get(x.label) for x in got)
    # lengths and sizes that can't be coded keep a row; null and non-finite vectors have none
    assert sorted(x.vec_id for x in got if x.code is None) == [504, 505, 506, 507]


def test_op12_few_vectors_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert codes.compress(spark.createDataFrame([], schema)).count() == 0
    assert codes.compress(spark.createDataFrame([(1, None, 1), (2, [float("nan")] * 16, 1)], schema)).count() == 0
    one = codes.compress(spark.createDataFrame([(3, [0.5] * 16, None)], schema)).first()
    assert (one.code, one.error, one.label_error) == ("00" * 16, 0, 0)
    assert one.codebooks_sha256 == hashlib.sha256(",".join(["128"] * 16).encode()).hexdigest()
    odd = codes.compress(spark.createDataFrame([(3, [0.5] * 5, None)], schema)).first()
    assert (odd.code, odd.error, odd.label_error) == (None, None, None)


# op13


def brute_middle(doc_id, text, seed=42):
    text = text or ""
    tokens = TOKEN.findall(text)
    drawn = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(tokens)
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def middle_texts():
    r = random.Random(3)
    words = ["one", "naïve", "日本", "é", "a b", "𝒳", "<P", "S>", "x" * 40]
    made = ["".join(r.choice(words) + r.choice([" ", "\n", "\t ", "\r\n", "\x0b", "\x0c"]) for _ in range(r.randint(1, 60))) for _ in range(60)]
    return [*made, *[t.strip() for t in made[:20]], None, "", " ", "\n\n", "  lead", "tail  ", "has <M> in it", "<P><S>", " ", made[0], made[0], "word " * 200_000]


def test_op13_borders_are_the_tokens_ends():
    for t in middle_texts():
        ends = fill_middle.boundaries(t or "")
        assert ends.tolist() == np.cumsum([len(x) for x in TOKEN.findall(t or "")]).tolist()[: len(ends)] and len(ends) == len(TOKEN.findall(t or ""))


def test_op13_lists_give_back_their_values():
    rng = np.random.default_rng(1)
    for n, chars in ((1, 1), (1, 10**6), (5, 5), (300, 301), (1000, 7000), (2000, 10**6), (70_000, 500_000)):
        values = np.sort(rng.choice(chars, n, replace=False)) + 1
        index = fill_middle.EliasFano.of(values, chars)
        at = range(n) if n < 3000 else rng.integers(0, n, 2000).tolist()
        assert [index[k] for k in at] == [int(values[k]) for k in at]
        assert len(index.low) + len(index.high) <= n * (2 + max(0, np.log2(chars / n))) / 8 + 4
        with pytest.raises(IndexError):
            index[n]


def test_op13_equals_brute_force(spark):
    texts = middle_texts()
    rows = [(i * 7 - 30, t, "en", "s", None) for i, t in enumerate(texts)]
    rows += [(None, texts[1], None, None, None), (5, texts[2], None, None, None), (5, texts[2], None, None, None), *((10_000 + i, texts[3], "en", "s", 1) for i in range(400))]
    given = clashing(spark.createDataFrame(rows, DOCS)).repartition(6)
    for copies in (256, 20):
        found = fill_middle.fill_in_middle(given, copies=copies).withColumn("back", fill_middle.restored())
        got = found.collect()
        key = lambda x: tuple((v is None, v) for v in x)
        want = [(d, *brute_middle(d, t)) for d, t, *_ in rows]
        assert sorted(((x.doc_id, x.n, x.form, x.prefix_chars, x.middle_chars, x.output) for x in got), key=key) == sorted(want, key=key)
        assert sorted(x.back for x in got) == sorted(t or "" for _, t, *_ in rows)
        assert {x.form for x in got} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(spark.createDataFrame([], DOCS)).count() == 0


def test_op13_texts_of_many_copies_are_dealt_to_entries(spark):
    rows = [(i, "the same text", "en", "s", 1) for i in range(3000)] + [(i, f"text {i}", "en", "s", 1) for i in range(3000, 3100)]
    keyed = fill_middle.keyed_texts(spark.createDataFrame(rows, DOCS).repartition(4), copies=100)
    shares = [r["count"] for r in keyed.where("text = 'the same text'").groupBy("share").count().collect()]
    assert len(shares) == 30 and max(shares) < 200 and sum(shares) == 3000
    assert keyed.where("share > 0 and text <> 'the same text'").count() == 0


def test_op13_a_shared_hash_mixes_up_nothing():
    index = fill_middle.TextIndex()
    a, b = index.find("one two three"), index.find("one")
    assert (a.n, b.n, index.find("one two three") is a, len(index.entries)) == (3, 1, True, 2)


# op11

WORDS = {
    "en": "the of and that with from which there would about their other were".split(),
    "de": "der und die nicht ein für auf sich werden über können schon müßte".split(),
    "fr": "les des une dans pour qui être avec était où français même très".split(),
    "el": "και του της στην από είναι που για με δεν αυτό όλα".split(),
}


def language_rows(n, seed=0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        lang = r.choice(sorted(WORDS))
        text = " ".join(r.choice(WORDS[lang]) for _ in range(r.randint(8, 60)))
        out.append((i, text.upper() if i % 9 == 0 else text, lang, "s", len(text)))
    return out


def test_op11_features_are_those_of_the_whole_text():
    texts = ["A b", "The  cat's 12 hats!", "x", "", " \n", "İstanbul Straße ΣΑΣ", "日本語 text", "ab " * 3000 + "zz9"]
    old = languages.STRETCH
    for t in texts:
        whole = languages.counts(t)
        letters = " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
        grams = [letters[k : k + n] for n in (1, 2, 3) for k in range(len(letters) - n + 1) if letters[k : k + n].strip()]
        if letters.strip():
            assert whole.sum() == len(grams)
        else:
            assert not whole.any()
        if "Σ" not in t:  # the last sigma of a word has a form of its own
            try:
                for languages.STRETCH in (1, 2, 3, 7, 100):
                    assert (languages.counts(t) == whole).all(), (t, languages.STRETCH)
            finally:
                languages.STRETCH = old


def test_op11_held_out_accuracy_and_awkward_rows(spark):
    rows = language_rows(600)
    odd = [(9001, None, "en", None, None), (9002, "", "de", None, None), (9003, "12 34 !! \n", "fr", "s", 1), (9004, "½ Ⅷ ²", "fr", "s", 1), (9005, "the of and that", None, "s", 1), (9006, "a", "en", "s", 1), (None, rows[0][1], rows[0][2], None, None), (9007, "the " * 300_000, "en", None, None), *[(9100 + i, rows[1][1], rows[1][2], "s", 1) for i in range(200)]]
    given = clashing(spark.createDataFrame(rows + odd, DOCS)).repartition(4)
    model = languages.fit(languages.learned(given))
    assert model.names == sorted(WORDS) and len(model.owner) > len(WORDS)
    got = languages.identify(given, model).withColumn("held_out", languages.held_out()).collect()
    assert len(got) == len(rows) + len(odd)
    by = {x.doc_id: x for x in got}
    assert all(by[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(600)) and by[None].held_out is False
    held = [i for i in range(600) if by[i].held_out]
    assert len(held) > 80 and sum(by[i].lang_pred == rows[i][2] for i in held) / len(held) > 0.98
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (9001, 9002, 9003, 9004))
    assert by[9005].lang_pred == by[9007].lang_pred == "en" and by[9006].lang_pred in WORDS
    assert all(0 <= x.score <= 1 for x in got)
    assert all(x.form == "mine" for x in got)


def test_op11_learns_from_nothing_else(spark):
    """Labels of held-out documents, sources and ids of others don't change a prediction."""
    rows = language_rows(300, 1)
    changed = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, f"other{i}", 0) for i, t, lang, _, _ in rows]
    found = []
    for r in (rows, changed):
        df = spark.createDataFrame(r, DOCS)
        found.append({(x.doc_id, x.lang_pred, x.score) for x in languages.identify(df.select("doc_id", "text"), languages.fit(languages.learned(df))).collect()})
    assert found[0] == found[1]


def test_op11_rejects_what_is_far_from_every_centroid(spark):
    df = spark.createDataFrame([*language_rows(300, 2), (9999, "qxzj wqkz vvqx zzjq", None, None, None)], DOCS)
    model = languages.fit(languages.learned(df))
    got = {x.doc_id: x for x in languages.identify(df, model, reject_as="und").collect()}
    assert got[9999].rejected and got[9999].lang_pred == "und" and sum(x.rejected for x in got.values()) < 12


def test_op11_without_anything_to_learn(spark):
    empty = spark.createDataFrame([], DOCS)
    assert languages.fit(languages.learned(empty)) is None
    assert languages.identify(empty, None).count() == 0
    one = languages.identify(spark.createDataFrame([(1, "text", None, None, None)], DOCS), None).first()
    assert (one.lang_pred, one.score, one.rejected) == ("und", 0.0, True)
