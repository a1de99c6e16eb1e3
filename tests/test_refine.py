"""The refinery on hand-made rows, by brute force, and under skew."""

import random

import pytest
from pyspark.sql import functions as F

from quernstone.operators import refine
from quernstone.plans import refinery
from tests.plain import plain_code, plain_doc

BODY = " ".join(f"w{i}" for i in range(25))


def code(tag):
    return f"{BODY} {tag}"


def brute(rows):
    """One row at a time, training rows first, with a set of what was seen."""
    seen, verdicts = set(), {}
    for wanted in ("train", "valid", "test"):
        for i, split, raw_code, raw_doc in sorted(r for r in rows if r[1] == wanted):
            doc, body = plain_doc(raw_doc), plain_code(raw_code)
            if not raw_code:
                verdicts[i] = "no_code"
            elif not doc or not any(c.isalnum() for c in doc) or len(body) < 10:
                verdicts[i] = "removed_doc"
            elif not (20 <= len(body.split()) <= 250 and 3 <= len(doc.split()) <= 50):
                verdicts[i] = "removed_len"
            elif "".join(body.split()) in seen:
                verdicts[i] = "removed_dupe"
            else:
                verdicts[i] = "kept"
                if split == "train":
                    seen.add("".join(body.split()))
    return verdicts


ROWS = [
    (1, "train", code("a"), "Adds two numbers"),
    (2, "train", code("a").replace(" ", "\n"), "Same body again"),
    (3, "valid", code("a") + "  # comment", "Leaks from train"),
    (4, "valid", code("b"), "Twice in valid"),
    (5, "valid", code("b"), "Twice in valid"),
    (6, "test", code("b"), "Valid and test"),
    (7, "train", code("c"), "..."),
    (8, "test", code("c"), "Failed train row is no leak"),
    (9, "train", "short", "Adds two numbers"),
    (10, "train", "", "No code at all"),
    (11, "train", None, "No code at all"),
    (12, "train", "x" * 9, "Nine characters here"),
    (13, "train", "x" * 10, "Ten characters here"),
    (14, "train", code("d"), None),
    (15, "test", code("e"), "Two words"),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, split string, code string, docstring string")


def verdicts_of(spark, rows):
    judged = refine.judge_pairs(frame(spark, rows))
    return {r.id: r.reason for r in refine.reject_reason(judged).collect()}


def test_known_rows(spark):
    got = verdicts_of(spark, ROWS)
    assert got == brute(ROWS)
    assert [got[i] for i in (1, 2, 3, 4, 5, 6, 8, 12, 13)] == [
        "kept", "removed_dupe", "removed_dupe", "kept", "kept", "kept", "kept", "removed_doc", "removed_len"]


def random_rows(n, seed):
    rng = random.Random(seed)
    docs = ["Adds two numbers", "...", "Two words", "Long " * 60, "Fine summary text :param x"]
    bodies = [code(i) for i in range(12)] + ["tiny", "", code("z") * 12]
    return [(i, rng.choice(["train", "train", "valid", "test"]), rng.choice(bodies), rng.choice(docs)) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_all_forms_agree_with_brute_force(spark, seed):
    rows = random_rows(400, seed)
    want = brute(rows)
    kept = {i for i, v in want.items() if v == "kept"}
    pairs = frame(spark, rows)
    judged, gated = refine.judge_pairs(pairs), refine.gate_pairs(pairs)
    split = {r[0]: r[1] for r in rows}
    assert verdicts_of(spark, rows) == want
    assert {r.id for r in refine.refine(pairs).collect()} == kept
    assert {r.id for r in refinery.refine_stored(pairs).collect()} == kept
    assert {r.id for r in refine.cross_split_anti(gated).collect()} == {i for i in kept if split[i] != "train"}
    train = refine.passed(judged).filter("split = 'train'")
    assert {r.id for r in refine.dedup_keep_first(train).collect()} == {i for i in kept if split[i] == "train"}
    leaks = refine.leakage_pairs(gated).collect()
    assert {r.id for r in leaks} == {i for i, v in want.items() if v == "removed_dupe" and split[i] != "train"}
    assert all(r.train_id in kept for r in leaks)
    audit = {r.split: r.asDict() for r in refine.refinery_audit(judged).collect()}
    for name in ("train", "valid", "test"):
        mine = [v for i, v in want.items() if split[i] == name]
        assert audit[name]["total"] == len(mine)
        for verdict in set(want.values()):
            assert audit[name][verdict] == mine.count(verdict)


def test_one_fingerprint_holds_most_rows(spark):
    hot = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, "valid").otherwise("train").alias("split"),
        F.lit(code("hot")).alias("code"), F.lit("The same summary everywhere").alias("docstring"),
    )
    kept = refine.refine(hot).collect()
    assert [r.id for r in kept] == [1]
    audit = {r.split: (r.kept, r.removed_dupe) for r in refine.refinery_audit(refine.judge_pairs(hot)).collect()}
    assert audit == {"train": (1, 19_999), "valid": (0, 10_000)}
