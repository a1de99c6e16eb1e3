"""Shingles, MinHash classes and line windows against plain Python over whole texts."""

import random
import re

import numpy as np
import pytest

from quernstone.llm.line_windows import drop_repeated_lines
from quernstone.llm.minhash import _candidates, _common, bands_needed, near_classes
from quernstone.llm.shingles import shingle_sets
from tests.llm.test_vectors import roots_of

SCHEMA = "doc_id long, text string, kept string, component string, bucket string, j string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def changed(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def documents(seed=1):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 90)) for _ in range(60)]
    base = prose(rng, 120)
    texts += [changed(rng, base, rng.randrange(4)) for _ in range(60)]
    chain = prose(rng, 70)
    for _ in range(12):
        chain = changed(rng, chain, 1)
        texts.append(chain)
    texts += [base] * 5 + [base.upper(), base.replace(" ", " \t\r\n"), None, None, "", " \n\t", "one", "ONE", "one two three four", "one two three four five", "  x y É é É é"]
    return list(enumerate(texts))


@pytest.mark.parametrize("percent", [80, 85])
def test_near_classes_against_all_pairs(spark, percent):
    rows = documents()
    sets = {i: plain_set(t) for i, t in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    roots = roots_of(sets, links)
    want = sorted((i, len(s), roots[i], roots[i] == i) for i, s in sets.items())
    assert sorted(map(tuple, near_classes(frame(spark, rows), percent=percent).collect())) == want


def test_near_classes_edges(spark):
    assert near_classes(frame(spark, [])).collect() == []
    got = near_classes(frame(spark, [(3, "a b"), (3, "a b"), (1, "A  B"), (None, "a b"), (2, None)])).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(3, 1, 1, False), (3, 1, 1, False), (1, 1, 1, True), (None, 1, None, True), (2, 0, 2, True)], key=str)
    assert (1 - 0.85**6) ** bands_needed(85) <= 1e-4


def test_unlinked_hubs_meet_linked_members(spark):
    alone = [(7, rep, 100, rep, False) for rep in range(10, 110)]
    members = [(7, 1, 100, 0, True), (7, 2, 100, 0, True), *alone]
    for turn in range(1, 4):
        pairs = _candidates(spark.createDataFrame(members, "bucket long, rep long, n long, comp long, linked boolean"), turn, 8, 85).collect()
        hubs = {r["lo"] for r in pairs if r["hi"] >= 10} | {r["hi"] for r in pairs}
        met = {r["hi"] for r in pairs if r["lo"] == 1 and r["hi"] >= 10}
        drawn = {h for h in hubs if sum(h in (r["hi"], r["lo"]) for r in pairs) > 50}
        assert drawn and {h for h in drawn if h >= 10} <= met


def test_near_classes_copies_that_reach_only_the_original(spark):
    rng = random.Random(6)
    base = prose(rng, 2000)
    texts = [base]
    for _ in range(300):
        words = base.split(" ")
        for at in rng.sample(range(2000), 20):
            words[at] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").createOrReplaceTempView("copies")
    sets = [plain_set(t) for t in texts]
    with_original = {k for k, s in enumerate(sets) if 100 * len(s & sets[0]) >= 85 * len(s | sets[0])}
    got = {r["doc_id"] for r in near_classes(spark.table("copies")).collect() if r["component_id"] == 0}
    assert len(with_original) == 301 and got == with_original


def test_common_sizes_of_sets():
    rng = random.Random(8)
    sets = [np.array(sorted(rng.sample(range(-30_000, 30_000), rng.randrange(1, 20_000))), np.int64) for _ in range(7)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    got = _common(sets)
    assert all(got[a, b] == want[a][b] for a in range(7) for b in range(7) if a != b)
    assert _common(sets[:3], sets[3:]).tolist() == [row[3:] for row in want[:3]]


def test_shingle_hashes_tell_sets_apart():
    rng = random.Random(4)
    texts = [t for _, t in documents(2)] + [prose(rng, 30_000)]
    got = [set(s.tolist()) for s in shingle_sets(texts)]
    want = [plain_set(t) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in want]
    for k in range(0, len(texts), 7):
        for m in range(0, len(texts), 5):
            assert len(got[k] & got[m]) == len(want[k] & want[m])


def plain_lines(rows, window=3):
    first, gone = {}, {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        lines = [(k, line) for k, line in enumerate((text or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", line)]
        gone[i] = set()
        for j in range(len(lines) - window + 1):
            body = tuple(line for _, line in lines[j : j + window])
            if first.setdefault(body, (i, j)) != (i, j):
                gone[i] |= {k for k, _ in lines[j : j + window]}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        n = sum(bool(re.search(r"[^\x20\x09-\x0D]", line)) for line in lines)
        out.append((i, n, len(gone[i]), None if text is None else "\n".join(line for k, line in enumerate(lines) if k not in gone[i])))
    return sorted(out, key=str)


def cut(df):
    return sorted(map(tuple, drop_repeated_lines(df).select("_row.doc_id", "n_lines", "n_removed", "_row.text").collect()), key=str)


def test_line_windows_against_plain_python(spark):
    rng = random.Random(9)
    pool = [f"line {k}" for k in range(14)] + ["", "  ", "\t", "é ü", "a\rb"]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 30)))) for k in range(60)]
    passage = "p1\n\np2\np3\np4"
    rows += [(100 + k, f"own {k}\n{passage}\nend {k}") for k in range(25)] + [(200, None), (201, ""), (202, "\n\n"), (203, "a\na\na\na\na"), (204, "x\ny")]
    assert cut(frame(spark, rows)) == plain_lines(rows)


def test_line_windows_keep_other_columns_and_repeats(spark):
    assert cut(frame(spark, [])) == []
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "z\na\nb\nc"), (None, "a\nb\nc")]
    assert cut(frame(spark, rows)) == sorted([(1, 3, 0, "a\nb\nc"), (1, 3, 0, "a\nb\nc"), (2, 4, 3, "z"), (None, 3, 3, "")], key=str)
    assert drop_repeated_lines(frame(spark, rows)).select("_row.*").columns == ["doc_id", "text", "kept", "component", "bucket", "j"]
