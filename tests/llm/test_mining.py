"""Exact copies, phrases and whitening against plain Python and numpy."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from quernstone.llm import common, exact_copies, phrases, whitening

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    *[T.StructField(c, T.StringType()) for c in ("length", "prefix", "n", "a", "phrase", "words", "block", "sha", "slot", "_row", "keep_id")],
])


def frame(spark, rows):
    return spark.createDataFrame([(*r, *"abcdefghijk") for r in rows], DOCS)


def plain_copies(rows):
    keyed = [(i, hashlib.sha256(re.sub("[ \t-\r]+", " ", t or "").encode()).hexdigest()) for i, t, *_ in rows]
    out = []
    for i, key in keyed:
        ids = [j for j, k in keyed if k == key]
        known = [j for j in ids if j is not None]
        least = min(known) if known else None
        out.append((i, least, len(ids), i == least, key))
    return sorted(out, key=str)


def copies():
    long = "word " * 60_000
    rows = [(k, "same text", "en") for k in range(400, 100, -1)]
    rows += [(1, None, "en"), (2, "", None), (3, " ", "en"), (4, "\n\t ", "en"), (5, "a  b", "en"), (6, "a b", "en"), (7, "a b", "en"), (8, "a\r\nb", "en")]
    rows += [(9, long + "x", "en"), (10, long + "y", "en"), (11, long.replace(" ", "\n") + "x", "en"), (12, "same text", "en"), (12, "same text", "en"), (None, "same text", "en")]
    rows += [(None, "only nulls", "en"), (None, "only nulls", "en"), (20, "x" * 70 + "1", "en"), (21, "x" * 70 + "2", "en"), (22, "x" * 70 + "1", "en")]
    return rows


@pytest.mark.parametrize("slots", [1, exact_copies.SLOTS])
def test_exact_classes(spark, slots):
    rows = copies()
    found = exact_copies.exact_classes(frame(spark, rows), digests=True, slots=slots)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_copies(rows)


def test_only_rivals_are_hashed(spark):
    rows = [(1, "abc", "x"), (2, "abcd", "x"), (3, "x" * 80 + "1", "x"), (4, "y" * 80 + "1", "x"), (5, "z" * 80 + "1", "x"), (6, "z" * 80 + "2", "x"), (7, "q r", "x"), (8, "q\tr", "x")]
    found = {r.doc_id: (r.text_sha256 is not None, r.kept) for r in exact_copies.exact_classes(frame(spark, rows)).collect()}
    assert found == {1: (False, True), 2: (False, True), 3: (False, True), 4: (False, True), 5: (True, True), 6: (True, True), 7: (True, True), 8: (True, False)}


def test_exact_plan_is_native(spark):
    plan = exact_copies.exact_classes(frame(spark, copies()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_copies_are_dropped(spark):
    rows = copies()
    left = exact_copies.drop_copies(frame(spark, rows))
    assert left.columns == DOCS.names
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter((i, t) for (i, t, _), k in zip(rows, (plain_keep(rows))) if k)


def plain_keep(rows):
    keys = [re.sub("[ \t-\r]+", " ", t or "") for _, t, _ in rows]
    least = {}
    for (i, *_), key in zip(rows, keys):
        if i is not None:
            least[key] = min(i, least.get(key, i))
    return [i == least.get(key) for (i, *_), key in zip(rows, keys)]


def plain_phrases(rows, words=3, min_count=10, top=2000, absorbed=50):
    counts, total = Counter(), Counter()
    for _, text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            w = re.findall("[^ \t]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, words + 1):
                for at in range(len(w) - k + 1):
                    counts[lang or "und", tuple(w[at : at + k])] += 1
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= min_count}
    held = Counter()
    for (lang, p), a in candidates.items():
        for size in range(2, len(p)):
            for at in range(len(p) - size + 1):
                held[lang, p[at : at + size]] = max(held[lang, p[at : at + size]], a)
    out = []
    for (lang, p), a in candidates.items():
        if (lang, p) in held and 100 * held[lang, p] >= absorbed * a:
            continue
        cuts = [(1_000_000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, score, a, " ".join(p), counts[lang, p[:k]], counts[lang, p[k:]]))
    ranked = []
    for lang in {o[0] for o in out}:
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[1], -o[2], o[3].encode()))[:top]
        ranked += [(lang, at + 1, p, a, l, r, total[lang], score) for at, (_, score, a, p, l, r) in enumerate(own)]
    return sorted(ranked)


def spoken(n, seed, vocabulary=12):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "délta", "ÉPS", "z\x1c", "tab wide", "the", "of", "new", "york", "city"][:vocabulary]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ; ", "\x0b", "!?"]
    return [(k, "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(60))), rng.choice(["en", "en", "de", None])) for k in range(n)]


@pytest.mark.parametrize("words,block", [(3, phrases.BLOCK_WORDS), (3, 50), (4, 200), (2, 1000)])
def test_collocations(spark, words, block):
    rows = spoken(150, words) + [(1, None, "en"), (1, "", "fr"), (None, "new york", "und"), (2, "\t \n", "de")] + [(3, "na " * 3000, "en"), (4, "New York city", "it")] * 2
    got = phrases.collocations(frame(spark, rows), words=words, block_words=block)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, words)


def test_keys_are_counted_in_compact_ranges(spark, monkeypatch):
    """What a task sends is a row per range of keys, a few bytes a key; all of it adds up exactly."""
    rng = np.random.default_rng(7)
    some = [np.sort(rng.choice(1 << phrases.COUNTED_BITS, 5000, replace=False).astype(np.uint64)) for _ in range(3)]
    blocks = [(k, rng.integers(1, 1 << 33, len(k))) for k in (some[0], some[1], np.append(some[0][:700], some[2]), np.empty(0, np.uint64))]
    want = Counter()
    for keys, n in blocks:
        for key, count in zip(keys.tolist(), n.tolist()):
            want[key] += count
    batches = [phrases._sent(blocks[:2], 5), phrases._sent(blocks[2:], 5), phrases._sent(blocks[3:], 5)]
    assert [b.num_rows for b in batches] == [5, 5, 0]
    got = Counter()
    for part in range(5):
        for b in batches:
            for row in b.filter(pc.equal(b.column("part"), part)).to_pylist():
                keys = np.cumsum(phrases._unpacked(row["gaps"], np.uint64), dtype=np.uint64)
                assert {key * 5 >> phrases.COUNTED_BITS for key in keys.tolist()} == {part}
                got.update(dict(zip(keys.tolist(), phrases._unpacked(row["n"], np.int64).tolist())))
    assert got == want
    monkeypatch.setattr(phrases, "HELD_KEYS", 100)
    monkeypatch.setattr(phrases, "PART_KEYS", 64)
    rows = [(i, " ".join(f"w{rng.zipf(1.3) % 90}" for _ in range(40)), ("en", None)[i % 2]) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    split, _ = phrases.frequent_phrases(docs, block_words=300)
    monkeypatch.setattr(phrases, "PART_KEYS", 1 << 30)
    whole, _ = phrases.frequent_phrases(docs, block_words=1 << 18)
    met = Counter((lang or "und", " ".join(w[k : k + n])) for _, text, lang in rows for w in [text.split(" ")] for n in (1, 2, 3) for k in range(len(w) - n + 1))
    frequent = {key: n for key, n in met.items() if n >= phrases.MIN_COUNT}
    assert {(r.lang, r.phrase): r.a for r in split.collect()} == {(r.lang, r.phrase): r.a for r in whole.collect()} == frequent


def test_collocations_whatever_the_map_lets_pass(spark, monkeypatch):
    rows = spoken(100, 9)
    monkeypatch.setattr(common.Marks, "__call__", lambda self, keys: np.ones(len(keys), dtype=bool))
    got = phrases.collocations(frame(spark, rows), min_count=15, top=7, absorbed=80)
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, min_count=15, top=7, absorbed=80)


def test_scores_beyond_64_bits(spark):
    every = spark.createDataFrame([("en", "x", 1, 4 * 10**12), ("en", "y", 1, 3 * 10**12), ("en", "x y", 2, 2 * 10**12 + 1)], "lang string, phrase string, words int, a long")
    sizes = spark.createDataFrame([("en", 10**13)], "lang string, n long")
    original = phrases.frequent_phrases
    try:
        phrases.frequent_phrases = lambda *a: (every, sizes)
        row = phrases.collocations(every, words=2).first()
    finally:
        phrases.frequent_phrases = original
    assert row.score == int(Fraction(1_000_000 * (2 * 10**12 + 1) ** 2, 12 * 10**24))


def test_long_text_is_read_in_steps(spark, monkeypatch):
    monkeypatch.setattr(phrases, "STEP_BYTES", 7)
    one = phrases._Open()
    one.add("Über den, Wolken und  so weiter\tund weiter.\nEnde  ")
    row = one.row(0, "de").to_pylist()[0]
    words = row["words"].split(" ")
    text = [words[c] if c >= 0 else "|" for c in np.frombuffer(row["codes"], dtype="<i4")]
    assert text == ["Über", "den", "|", "wolken", "und", "so", "weiter", "und", "weiter", "|", "ende", "|"]


def test_empty_tables(spark):
    nothing = frame(spark, [])
    assert exact_copies.exact_classes(nothing).count() == 0
    assert phrases.collocations(nothing).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(vectors).count() == 0


matrices = st.integers(1, 12).flatmap(lambda d: st.lists(st.lists(st.floats(-100, 100), min_size=d, max_size=d), min_size=1, max_size=12))


@settings(max_examples=200, deadline=None)
@given(matrices)
def test_leading_components(lines):
    x = np.array(lines)
    a = x.T @ x
    values, vectors = whitening.leading_components(a, 5)
    want = np.linalg.eigvalsh(a)[::-1][: len(values)]
    scale = max(want.max(initial=0), 1e-300)
    assert np.abs(values - want).max(initial=0) <= 1e-12 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-10
    assert np.abs(a @ vectors - vectors * values).max(initial=0) <= 1e-10 * scale
    left = np.linalg.eigvalsh(a)[::-1][len(values) : 5]
    assert (left <= 1e-12 * scale).all()


@pytest.mark.parametrize("size", [2, 7, 40])
def test_clusters_of_equal_values(size):
    rng = np.random.default_rng(size)
    q = np.linalg.qr(rng.standard_normal((size, size)))[0]
    exact = np.repeat([9.0, 9.0 - 1e-13, 4.0, 1e-3], size)[:size]
    a = (q * exact) @ q.T
    values, vectors = whitening.leading_components((a + a.T) / 2, size)
    assert len(values) == size and np.abs(values - np.sort(exact)[::-1]).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(size)).max() < 1e-12


def test_sturm_counts():
    rng = np.random.default_rng(3)
    d, e = rng.standard_normal(9), rng.standard_normal(8)
    e[4] = 0
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-4, 4, 41)
    assert whitening.sturm_counts(d, e, at).tolist() == [(values < x).sum() for x in at]


VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    *[T.StructField(c, T.StringType()) for c in ("n", "component", "id", "vec", "whitened")],
])


def plain_whitened(vectors, count):
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    y = ((x * n - s) / n).astype(float)
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    order = np.argsort(-e)[:count]
    return n, ((x * n - s) ** 2).sum(axis=1).tolist(), y @ q[:, order] / np.sqrt(e[order]), e[order] / np.trace(v)


def test_whitening(spark):
    rng = np.random.default_rng(8)
    able = (rng.standard_normal((300, 20)) @ rng.standard_normal((20, 20))).astype(np.float32).tolist()
    able[:100] = [able[0]] * 100
    rows = [(k, v) for k, v in enumerate(able)]
    odd = [(900, None), (901, [float("nan")] * 20), (902, [None] + [1.0] * 19), (903, [float("inf")] * 20), (904, []), (905, [1.0, 2.0])]
    rows[5] = (None, rows[5][1])
    rows[6] = (7, rows[6][1])
    got = whitening.whiten(spark.createDataFrame([(*r, *"abcde") for r in rows + odd], VECTORS), 8)
    assert got.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    n, deviation, z, share = plain_whitened(able, 8)
    out = got.collect()
    assert len(out) == 300 * 8 and {r.n for r in out} == {300} == {n}
    assert max(r.identity_error for r in out) < 1e-9
    assert Counter((r.vec_id, r.deviation) for r in out if r.component == 1) == Counter(zip([i for i, _ in rows], deviation))
    for k in range(8):
        own = {r.vec_id: r.whitened for r in out if r.component == k + 1 and r.vec_id not in (None, 7)}
        want = {i: z[at, k] for at, (i, _) in enumerate(rows) if i not in (None, 7)}
        sign = np.sign(own[0] * want[0])
        assert max(abs(own[i] - sign * want[i]) for i in want) < 1e-8
        assert abs(next(r.explained for r in out if r.component == k + 1) - share[k]) < 1e-10


def test_whitening_without_spread(spark):
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(5)], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).count() == 0
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 0.0]) for k in range(5)], "vec_id long, embedding array<float>")
    assert sorted((r.component, r.deviation) for r in whitening.whiten(line).collect()) == sorted((1, (5 * 64 * k - 640) ** 2 * 5) for k in range(5))


def test_deviations_of_large_values():
    sums = [2**58, 5]
    centre = whitening._Centre(3, sums)
    x = np.array([[2**57, 1], [1_000_000, 2], [3, 3]], dtype=np.int64)
    want = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert centre.deviations(x) == [w if w < 2**63 else None for w in want]
