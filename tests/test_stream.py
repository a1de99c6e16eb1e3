"""Arriving shards against the batch refinery."""

import json

import pandas as pd
from pyspark.sql import functions as F

from quernstone.operators import refine
from quernstone.sources import jsonl
from quernstone.streaming import refine_stream as stream
from tests.test_refine import frame, random_rows
from tests.test_sources import write_gz


def write(root, rows, tag):
    for split in ("train", "valid", "test"):
        for part in range(3):
            lines = [json.dumps({"code": c, "docstring": d}) for i, s, c, d in rows if s == split and i % 3 == part]
            write_gz(f"{root}/in/{split}/{tag}_{part}.jsonl.gz", lines)


def run(spark, root):
    lines = stream.stream_shards(spark, f"{root}/in")
    query = stream.refine_stream(lines, f"{root}/out", f"{root}/state")
    query.awaitTermination()
    return query


def fingerprints(df):
    return sorted((r.split, r.fp) for r in df.select("split", "fp").collect())


def test_two_arrivals_match_one_batch(spark, tmp_path):
    rows = random_rows(240, 4)
    train = [r for r in rows if r[1] == "train"]
    held_out = [r for r in rows if r[1] != "train"]
    write(tmp_path, train[:60], "early")
    run(spark, tmp_path)
    write(tmp_path, train[60:] + held_out, "late")
    run(spark, tmp_path)
    gated = refine.gate_pairs(frame(spark, rows))
    want = refine.train_registry(gated).withColumn("split", F.lit("train")).select("split", "fp").unionByName(refine.cross_split_anti(gated).select("split", "fp"))
    assert fingerprints(stream.read_stream_output(spark, f"{tmp_path}/out")) == fingerprints(want)
    assert jsonl.read_jsonl_shards(spark, f"{tmp_path}/in").count() == len(rows)


def pair(k):
    return " ".join(f"word{k}_{i}" for i in range(40)), f"Adds number {k} to another one and returns what comes of it."


def test_a_batch_asks_for_its_own_keys(spark, tmp_path):
    """Three arrivals, the first large: later ones look up no more keys than they bring."""
    asked = []
    for tag, (first, last) in {"a": (0, 600), "b": (600, 610), "c": (5, 15)}.items():
        rows = [(k, "train", *pair(k)) for k in range(first, last)] + [(k, "test", *pair(k)) for k in (first, first + 1, 10_000 + first)] * 2
        write(tmp_path, rows, tag)
        asked.append(run(spark, tmp_path).recentProgress[0].stateOperators[0].customMetrics["rocksdbGetCount"])
    out = stream.read_stream_output(spark, f"{tmp_path}/out").groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("fp").alias("fps")).collect()
    assert {r.split: (r.n, r.fps) for r in out} == {"train": (610, 610), "test": (6, 3)}
    assert max(asked[1:]) <= 4 * stream.SALTS * 13 < asked[0]


def test_frequent_fingerprints_are_dealt_out(spark, tmp_path):
    rows = pd.DataFrame([("test", "c", "d", "x")] * 80 + [("train", "c", "d", "y")] * 50, columns=stream.KEPT)
    dealt = pd.concat(stream._first_copies(iter([rows])))
    counts = dealt.groupby(["split", "salt"]).size()
    assert (counts["test"] == 10).all() and (counts["train"] == 1).all() and len(counts) == 2 * stream.SALTS


def test_a_marker_costs_no_frame():
    """Markers are seven of eight groups; telling that one is a training row takes no frame of its own."""

    class State:
        exists, value = False, None

        def update(self, value):
            self.value = value

    class Rows(pd.DataFrame):
        def __getitem__(self, key):
            assert key == "split"
            return super().__getitem__(key)

    state = State()
    marker = Rows([("test", "c", "d", "x"), ("train", None, None, "x")], columns=stream.KEPT)
    assert list(stream._judge(("x", 3), iter([marker]), state)) == [] and state.value == (True,)
    rows = pd.DataFrame([("test", "a", "d", "x"), ("train", "b", "d", "x"), ("train", "c", "d", "x")], columns=stream.KEPT)
    (kept,) = stream._judge(("x", 0), iter([rows]), State())
    assert kept.to_numpy().tolist() == [["train", "b", "d", "x"]]
