"""Vector operators against numpy over all pairs."""

import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import types as T

from quernstone.llm.components import connected_components
from quernstone.llm.near_vectors import bits_for, near_vectors, tables_needed
from quernstone.llm.vector_search import top_k_inner
from quernstone.session import shared_folder

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    T.StructField("n_links", T.StringType()), T.StructField("rep", T.StringType()), T.StructField("score", T.StringType()),
])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)


def roots_of(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def plain_links(rows, threshold=0.98):
    def cosine(v, w):
        a, b = np.float32(v).astype(float), np.float32(w).astype(float)
        return a @ b / (np.linalg.norm(a) * np.linalg.norm(b))

    able = [r for r in rows if r[0] is not None and r[2] is not None and good(r[1]) and any(r[1])]
    return [(a[0], b[0]) for a in able for b in able if a is not b and a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= threshold]


def cluster(rng, n, first, label, noise=0.02, dim=16):
    centre = rng.standard_normal(dim)
    return [(first + k, (centre + noise * rng.standard_normal(dim)).astype(np.float32).tolist(), label) for k in range(n)]


def vectors():
    rng = np.random.default_rng(5)
    rows = cluster(rng, 40, 100, 1) + cluster(rng, 30, 200, 2, 0.06) + cluster(rng, 5, 300, None)
    rows += [(400 + k, rng.standard_normal(16).tolist(), k % 2) for k in range(60)]
    same = rng.standard_normal(16).astype(np.float32).tolist()
    rows += [(9 - k, same, 1) for k in range(9)] + [(700, [2 * x for x in same], 1)]
    rows += [
        (500, None, 1), (501, [], 1), (502, [0.0] * 16, 1), (503, [float("nan")] * 16, 1), (504, [float("inf")] * 16, 1),
        (505, [None] * 16, 1), (506, [1.0, 2.0], 1), (507, [1.0, 2.0], 1), (None, same, 1), (508, [1e30] * 16, 3), (509, [1e-30] * 16, 3),
    ]
    return rows


@pytest.mark.parametrize("block, batch, bits", [(7, 10_000, None), (1024, 10_000, None), (7, 3, 4), (1024, 5, 2), (1024, 10_000, 14)])
def test_near_vectors_against_all_pairs(spark, block, batch, bits):
    """Small and large blocks, blocks that go over several batches, crowded and thin buckets."""
    rows = vectors()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        check_near_vectors(spark, rows, block, bits)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def check_near_vectors(spark, rows, block, bits):
    links = plain_links(rows)
    roots = roots_of([r[0] for r in rows if r[0] is not None], links)
    degree = {n: sum(a == n for a, _ in links) for n in roots}
    got = near_vectors(frame(spark, rows), block=block, bits=bits).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (degree[r.vec_id], roots[r.vec_id], roots[r.vec_id] == r.vec_id), r


def test_near_vectors_of_nothing_and_repeats(spark):
    assert near_vectors(frame(spark, [])).collect() == []
    got = near_vectors(frame(spark, [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1)])).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]


def test_near_vectors_leave_only_what_the_result_reads(spark):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    got = near_vectors(frame(spark, vectors()))
    left = {p.name.rpartition("-")[0] for p in set(folder.iterdir()) - before if any(p.glob("*.parquet"))}
    assert left == {"vectors", "solved"} and got.count() == len(vectors())


def test_bits_grow_with_the_rows():
    assert [bits_for(n) for n in (0, 1, 256, 257, 1 << 20, 10**10)] == [8, 8, 8, 9, 20, 34]


def test_tables_follow_the_miss_rate():
    same = (1 - math.acos(0.98) / math.pi) ** 14
    assert (1 - same) ** tables_needed(0.98, 14, 1e-4) <= 1e-4 < (1 - same) ** (tables_needed(0.98, 14, 1e-4) - 1)


def test_components_against_union_find(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1040)] + [(5000, k) for k in range(4000, 4200)]
    edges += [(7, 7), (None, 3), (4, None), (1001, 1000)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()))
    known = [(a, b) for a, b in edges if a is not None and b is not None]
    want = roots_of({n for e in known for n in e}, known)
    assert got == {n: r for n, r in want.items() if n != r}
    assert connected_components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def plain_top(rows, asked, k=10):
    whole = [(i, np.floor(1024 * np.float32(v).astype(float)).astype(int).astype(object)) for i, v, _ in rows if i is not None and good(v)]
    out = []
    for q, v in whole:
        if q in asked:
            ranked = sorted((-int(v @ w), i) for i, w in whole if i != q and len(w) == len(v))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(16, 3), (32768, 2048)])
def test_top_k_against_all_pairs(spark, sizes):
    rng = np.random.default_rng(8)
    rows = [(k, rng.standard_normal(8).astype(np.float32).tolist(), 0) for k in range(150)]
    rows += [(200 + k, [1.0] * 8, 0) for k in range(14)] + [(300 + k, [1e4 * (k - 2)] * 8, 0) for k in range(5)]
    rows += [(400, None, 0), (401, [], 0), (402, [float("nan")] * 8, 0), (403, [None] * 8, 0), (404, [float("-inf")] * 8, 0), (None, [1.0] * 8, 0), (405, [1.0, 2.0], 0), (406, [7e4, -3e5] * 4, 0), (420, [9e6] * 4 + [-1e6] * 4, 0)]
    df = frame(spark, rows)
    got = top_k_inner(df, df.filter("vec_id % 20 = 0 OR vec_id > 395"), block_rows=sizes[0], query_rows=sizes[1])
    asked = {r[0] for r in rows if r[0] is not None and (r[0] % 20 == 0 or r[0] > 395)}
    assert sorted(map(tuple, got.collect())) == plain_top(rows, asked)


def test_top_k_of_any_size(spark):
    """Every finite vector takes part, and only a ranked score that is no long is an error."""
    df = frame(spark, [(100, [7e4, 0.0], 0), (1, [1.0, 1.0], 0), (200, [1.0, 2.0], 0)])
    want = {(100, 200): 70_000 << 20, (100, 1): 70_000 << 20, (200, 100): 70_000 << 20, (200, 1): 3 << 20}
    assert {(r.query_id, r.vec_id): r.score for r in top_k_inner(df, df.filter("vec_id >= 100")).collect()} == want
    rows = [(k, [-1.0, float(k)], 0) for k in range(12)] + [(50, [1e30, 0.0], 0), (51, [3e9, -1e9], 0)]
    df = frame(spark, rows)
    got = sorted(map(tuple, top_k_inner(df, df.filter("vec_id = 3")).collect()))
    assert [g[2] for g in got] == [11, 10, 9, 8, 7, 6, 5, 4, 2, 1] and got[0][3] == (1 + 33) << 20
    with pytest.raises(Exception, match="too large"):
        top_k_inner(df, df.filter("vec_id = 51")).collect()


def test_top_k_small_and_empty(spark):
    assert top_k_inner(frame(spark, []), frame(spark, [])).collect() == []
    df = frame(spark, [(1, [0.5, 0.5], 0), (2, [0.25, -1.0], 0)])
    assert sorted(map(tuple, top_k_inner(df, df).collect())) == [(1, 1, 2, 512 * 256 - 512 * 1024), (2, 1, 1, 512 * 256 - 512 * 1024)]
