"""Near-duplicate texts: one-permutation hashing with optimal densification, banded buckets, star edges."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import apart, forget, frugal, key_runs, lean_batches, marks_of, mix64, stored, stored_with
from quernstone.llm.components import connected_components
from quernstone.llm.near_vectors import _roots
from quernstone.llm.shingles import WORDS, shingle_sets

ROWS = 6
MISS = 1e-4
HUBS = 4
BLOCK_ROWS = 256
BLOCK_SHINGLES = 1 << 21
STEP = 4096
WORTH = 10
SKETCH = "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>"
SETS = "rep long, items array<long>"
SEED = 97


def bands_needed(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """How many bands leave a pair at the threshold without a common bucket with probability ``miss`` at most."""
    agree = (percent / 100) ** rows
    return 1 if agree >= 1 else max(1, math.ceil(math.log(miss) / math.log1p(-agree)))


class OneHash:
    """Signatures of ``size`` bins from a single hash per shingle.

    A bin keeps the least hash of its range. An empty bin borrows from a bin that its own fixed sequence
    of random numbers names, the first one that is not empty: optimal densification.
    """

    def __init__(self, size: int, seed: int = SEED):
        self.size = size
        width = (1 << 64) / size
        self.low = np.array([math.ceil(k * width) for k in range(size)], dtype=np.uint64)
        self.seed = np.uint64(seed)

    def __call__(self, items: np.ndarray) -> np.ndarray:
        at = np.searchsorted(items, self.low)
        ends = np.append(at[1:], len(items))
        empty = at == ends
        source = np.arange(self.size)
        todo, turn = np.flatnonzero(empty), 0
        while len(todo):
            turn += 1
            probe = (mix64(todo.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn) + (self.seed << np.uint64(32))) % np.uint64(self.size)).astype(np.int64)
            found = ~empty[probe]
            source[todo[found]] = probe[found]
            todo = todo[~found]
        return items[at[source]]


def _fold(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    table = signature[: bands * rows].reshape(bands, rows)
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        out = mix64(out ^ table[:, k])
    return out.astype(np.int64)


def _sketches(bands: int, rows: int, words: int, seed: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = OneHash(bands * rows, seed)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                n, f1, f2, banded = [], [], [], []
                for items in shingle_sets(part.column("text").to_pylist(), words):
                    n.append(len(items))
                    f1.append(int(np.bitwise_xor.reduce(mix64(items ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64)) if len(items) else 0)
                    f2.append(int(np.add.reduce(mix64(items + np.uint64(0x14057B7EF767814F)), dtype=np.uint64).view(np.int64)) if len(items) else 0)
                    banded.append(_fold(hasher(items), bands, rows) if len(items) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(banded, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "f1", "f2", "bands"],
                )

    return work


def _full_sets(words: int, wanted: Broadcast):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            batch = batch.filter(pa.array(wanted.value(keys)))
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                items = [s.view(np.int64) for s in shingle_sets(part.column("text").to_pylist(), words)]
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(items, pa.list_(pa.int64()))], names=["rep", "items"])

    return work


def _sets_of(text: DataFrame, member: DataFrame, words: int) -> DataFrame:
    """Full sets of the texts whose id is in a crowded bucket, stored.

    A map of marked ids goes to the scan, so no text is moved and few others are cut into shingles; a
    set that nobody asked for meets no pair.
    """
    key = F.xxhash64("rep").alias("key")
    ids = stored(member.select("rep").distinct().select(key), "wanted")
    wanted = text.sparkSession.sparkContext.broadcast(marks_of(ids, ids.count()))
    rows = text.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("rep"), "text").select("rep", "text", key)
    items = stored(rows.mapInArrow(frugal(_full_sets(words, wanted)), SETS), "sets")
    forget(ids)
    return items


def _linked(a: Column, b: Column, percent: int) -> Column:
    """Whether two full sets reach the threshold."""
    common = F.size(F.array_intersect(a, b))
    return (common > 0) & (100 * common >= percent * (F.size(a) + F.size(b) - common))


def _candidates(member: DataFrame, turn: int, hubs: int, percent: int) -> DataFrame:
    """Star edges from a few hubs of each bucket to its members of other components, linked or not."""
    order = [F.struct(F.xxhash64(F.lit(1000 * turn + k), "rep").alias("h"), "rep", "comp", "n") for k in range(hubs)]
    chosen = member.groupBy("bucket").agg(F.array_distinct(F.array(*[F.min(o) for o in order])).alias("hubs"), F.min("comp").alias("c1"), F.max("comp").alias("c2"))
    centre = apart(chosen.filter("c1 <> c2").select("bucket", "hubs"), "bucket")
    edges = member.join(centre, "bucket").select("rep", "comp", "n", F.explode("hubs").alias("hub"))
    small, large = F.least("n", F.col("hub.n")), F.greatest("n", F.col("hub.n"))
    worth = F.col("hub.comp") != F.col("comp")
    return edges.filter(worth & (100 * small >= percent * large)).select(
        F.greatest("rep", "hub.rep").alias("hi"), F.least("rep", "hub.rep").alias("lo")
    ).distinct()


def _labels(known: DataFrame | None, links: DataFrame) -> DataFrame:
    """``node, label`` after further links: the least label next to a node, followed once more.

    A label is always a node that its owner is connected with; it need not be the least one yet.
    """
    both = links.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionByName(links.select(F.col("lo").alias("node"), F.col("hi").alias("other")))
    if known is None:
        near = both.toDF("node", "label")
    else:
        lifted = both.join(known.select(F.col("node").alias("other"), "label"), "other", "left")
        near = known.unionByName(lifted.select("node", F.coalesce("label", "other").alias("label")))
    once = stored(near.groupBy("node").agg(F.min("label").alias("label")).select("node", F.least("node", "label").alias("label")), "labels")
    up = once.select(F.col("node").alias("label"), F.col("label").alias("_up"))
    return stored(once.join(up, "label", "left").select("node", F.coalesce("_up", "label").alias("label")), "labels")


def _components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``node, component``: links between different labels are solved exactly, labels then follow."""
    def lifted(end: str) -> DataFrame:
        return labels.select(F.col("node").alias(end), F.col("label").alias(f"_{end}"))

    ends = links.join(lifted("hi"), "hi", "left").join(lifted("lo"), "lo", "left")
    roots = connected_components(ends.select(F.coalesce("_hi", "hi").alias("a"), F.coalesce("_lo", "lo").alias("b")), "a", "b")
    up = roots.select(F.col("node").alias("label"), F.col("component").alias("_up"))
    followed = labels.join(up, "label", "left").select("node", F.coalesce("_up", "label").alias("component"))
    return followed.unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))


def _common(a: list[np.ndarray], b: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of the sets of ``a`` with those of ``b``, or with each other.

    A set with itself is not counted right: items that no other set holds are left out.
    """
    sets = a + (b or [])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    code, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    shared = n[code] > 1
    code, owner = (np.cumsum(n > 1) - 1)[code[shared]], owner[shared]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    out = np.zeros((len(a), len(a if b is None else b)))
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, STEP):
        at, end = np.searchsorted(code, [low, low + STEP])
        x = np.zeros((len(sets), STEP), dtype=np.float32)
        x[owner[at:end], code[at:end] - low] = 1
        out += x[: len(a)] @ (x if b is None else x[len(a) :]).T
    return out


def _block_links(percent: int):
    keys = ["bucket", "i", "j"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in key_runs(batches, keys):
            i, j = int(block["i"].iloc[0]), int(block["j"].iloc[0])
            a = block[block["chunk"] == i]
            b = a if i == j else block[block["chunk"] == j]
            other = a["comp"].to_numpy()[:, None] != b["comp"].to_numpy()[None, :]
            if not other.any():
                continue
            common = _common(a["items"].to_list(), None if i == j else b["items"].to_list())
            union = a["items"].map(len).to_numpy()[:, None] + b["items"].map(len).to_numpy()[None, :] - common
            linked = other & (common > 0) & (100 * common >= percent * union)
            if i != j:
                size = len(a)
                cross, linked = linked, np.zeros((size + len(b),) * 2, dtype=bool)
                linked[:size, size:], linked[size:, :size] = cross, cross.T
            some = linked.any(axis=1)
            if some.any():
                ids = (a if i == j else pd.concat([a, b]))["rep"].to_numpy()
                yield pd.DataFrame({"hi": ids, "lo": _roots(ids, linked)})[some]

    return work


def _rest(member: DataFrame, roots: DataFrame, items: DataFrame, percent: int) -> DataFrame | None:
    """Links ``hi, lo`` of all pairs of different components in buckets that still hold several.

    Buckets of two are settled by any hub; buckets with the same members are compared once. Members are
    dealt into chunks, bounded in texts and shingles, and all pairs of chunks are compared as matrices,
    in many tasks; of each text only the least one it is connected with leaves a task.
    """
    now = member.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "rep", "n", F.coalesce("component", "rep").alias("comp"))
    marks = [F.expr(f"bit_xor(xxhash64({k}, rep))").alias(f"x{k}") for k in range(2)]
    held = now.groupBy("bucket").agg(F.count("*").alias("m"), F.sum("n").alias("s"), F.min("comp").alias("c1"), F.max("comp").alias("c2"), *marks)
    chunks = F.greatest(F.ceil(F.col("m") / BLOCK_ROWS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int")
    unsettled, seen = stored_with(
        held.filter("m > 2 AND c1 <> c2").groupBy("m", "s", "x0", "x1").agg(F.min("bucket").alias("bucket")).select("bucket", chunks.alias("chunks")),
        "unsettled", buckets=F.count("*"),
    )
    if not seen["buckets"]:
        return None
    placed = (
        now.join(unsettled, "bucket")
        .withColumn("chunk", F.pmod(F.xxhash64("bucket", "rep"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("bucket", "rep", "comp", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    )
    keys = ["bucket", "i", "j"]
    tasks = int(member.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wide = placed.join(items, "rep").repartition(tasks, *keys).sortWithinPartitions(*keys)
    links, seen = stored_with(wide.mapInPandas(frugal(_block_links(percent)), "hi long, lo long"), "rest", links=F.count("*"))
    return links if seen["links"] else None


def near_classes(
    docs: DataFrame, percent: int = 85, words: int = WORDS, rows: int = ROWS, miss: float = MISS, hubs: int = HUBS,
    id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row for every row of ``docs``.

    Rows link when ``100 * intersection >= percent * union`` of their sets of distinct shingles; equal
    sets are one class from the start. Classes meet in banded buckets. In every turn each bucket that
    still holds several components names a few hubs, others each time and twice as many after the
    first, and edges between a hub and members of other components are checked, on full sets. Links merge
    components, and further turns with other hubs follow until one finds no pair it has not checked or
    links less than one in ``WORTH`` of those it checks. Buckets that hold several components then are compared pair by pair, in blocks, so
    every pair that shares a bucket is checked or inside one component: the cost of that is quadratic in
    the members of such a bucket.

    Null and blank texts have an empty set and link with nothing. Rows that repeat an id share their
    component. Null ids are kept alone. Empty tables give no rows; other columns are ignored.
    """
    lean_batches(docs.sparkSession)
    bands = bands_needed(percent, rows, miss)
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = stored(text.mapInArrow(frugal(_sketches(bands, rows, words, seed)), SKETCH), "sketch")
    usable = "n_shingles > 0 AND doc_id IS NOT NULL"
    shape = ["f1", "f2", "n_shingles"]
    classes = stored(
        sketch.filter(usable).groupBy(*shape).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes"
    )
    placed = classes.select("rep", F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "value")).select(
        "rep", "n", F.xxhash64("band", "value").alias("bucket")
    )
    crowded = placed.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1").select("bucket")
    member = stored(placed.join(apart(crowded, "bucket"), "bucket"), "members")
    items = _sets_of(text, member, words)
    spark = docs.sparkSession
    checked = spark.createDataFrame([], "hi long, lo long")
    links, labels, turn = None, None, 0
    while True:
        if labels is None:
            now = member.withColumn("comp", F.col("rep"))
        else:
            known = member.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
            now = known.select(*member.columns, F.coalesce("label", "rep").alias("comp"))
        wanted = _candidates(now, turn, 2 * hubs if turn else hubs, percent).join(checked, ["hi", "lo"], "left_anti")
        pairs = stored(wanted, "candidates")
        pairs = pairs if turn else pairs.hint("merge")  # the first turn is large wherever the table is
        both = pairs.join(items.toDF("lo", "b"), "lo")
        both = (both if turn else both.hint("merge")).join(items.toDF("hi", "a"), "hi")
        result, seen = stored_with(
            both.select("hi", "lo", _linked(F.col("a"), F.col("b"), percent).alias("link")), "pairs", found=F.count("*"), links=F.count(F.when(F.col("link"), 1))
        )
        checked = checked.unionByName(result.select("hi", "lo"))
        turn += 1
        if seen["links"]:
            new = result.filter("link").select("hi", "lo")
            links = new if links is None else links.unionByName(new)
            labels = _labels(labels, new)
        if WORTH * seen["links"] < seen["found"] or not seen["found"]:
            break
    roots = spark.createDataFrame([], "node long, component long") if links is None else stored(_components(labels, links), "roots")
    rest = _rest(member, roots, items, percent)
    if rest is not None:
        roots = _components(roots.withColumnRenamed("component", "label"), rest)
    solved = stored(
        classes.select(*shape, "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select(*shape, F.coalesce("component", "rep").alias("component")), "solved",
    )
    inside = sketch.filter(usable).join(solved, shape).select("doc_id", "n_shingles", "component")
    alone = sketch.filter(f"NOT ({usable})").select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    return inside.unionByName(alone).select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("component")).alias("kept")
    )
