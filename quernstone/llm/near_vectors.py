"""Near copies among vectors: sign hashes of random hyperplanes, exact cosine, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import apart, forget, frugal, stored, stored_with
from quernstone.llm.components import connected_components

FEWEST_BITS, MOST_BITS = 8, 40
MISS = 1e-4
BLOCK = 1024
SMALL = 64
CELLS = 1 << 18
SEED = 20_011
OUT = "rep long, links long, root long"


def tables_needed(threshold: float, bits: int, miss: float) -> int:
    """How many hash tables leave a pair at the threshold unseen with probability ``miss`` at most."""
    same_table = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** bits
    return 1 if same_table >= 1 else max(1, math.ceil(math.log(miss) / math.log1p(-same_table)))


def bits_for(rows: int) -> int:
    """As many bits as give each of ``rows`` vectors about one random partner in a table, at any size."""
    return min(MOST_BITS, max(FEWEST_BITS, math.ceil(math.log2(max(1, rows)))))


def usable(vector: Column) -> Column:
    """Not null, not empty, every component finite, not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def _hasher(tables: int, bits: int, seed: int):
    planes: dict[int, np.ndarray] = {}
    weights = (1 << np.arange(bits, dtype=np.int64))

    @F.pandas_udf("array<long>")
    def hashes(vectors: pd.Series) -> pd.Series:
        out = np.empty(len(vectors), dtype=object)
        sizes = np.array([len(v) for v in vectors], dtype=np.int64)
        for dim in np.unique(sizes):
            if dim not in planes:
                planes[dim] = np.random.default_rng((seed, int(dim))).standard_normal((dim, tables * bits))
            at = np.flatnonzero(sizes == dim)
            x = _scaled(np.stack([vectors.iloc[i] for i in at]).astype(np.float64))
            signs = (x @ planes[dim] >= 0).reshape(len(at), tables, bits)
            out[at] = list(signs.astype(np.int64) @ weights)
        return pd.Series(out)

    return hashes


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two (exact), so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    x = _scaled(np.stack(vectors.to_list()).astype(np.float64))
    return x, np.sqrt((x * x).sum(axis=1))


def _linked(a: pd.DataFrame, b: pd.DataFrame, table: int, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold and share no earlier table."""
    (x, nx), (y, ny) = _unit(a["vec"]), _unit(b["vec"])
    close = (x @ y.T) / (nx[:, None] * ny[None, :]) >= threshold
    if table and close.any():
        s, t = np.stack(a["hashes"].to_list()), np.stack(b["hashes"].to_list())
        for k in range(table):
            close &= s[:, k][:, None] != t[:, k][None, :]
    return close


def _roots(ids: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Smallest id reachable inside symmetric link matrices; leading axes number the matrices."""
    root = ids.copy()
    while True:
        best = np.minimum(root, np.where(linked, root[..., None, :], np.iinfo(np.int64).max).min(axis=-1))
        if (best == root).all():
            return root
        root = best


def _large_block(block: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links inside one chunk, or between two chunks, of a bucket."""
    table, i, j = (int(block[k].iloc[0]) for k in ("t", "i", "j"))
    if i == j:
        linked = _linked(block, block, table, threshold)
        np.fill_diagonal(linked, False)
        every = block
    else:
        a, b = block[block["chunk"] == i], block[block["chunk"] == j]
        every = pd.concat([a, b], ignore_index=True)
        linked = np.zeros((len(block), len(block)), dtype=bool)
        if len(a) and len(b):
            cross = _linked(a, b, table, threshold)
            linked[: len(a), len(a):] = cross
            linked[len(a):, : len(a)] = cross.T
    some = linked.any(axis=1)
    ids = every["rep"].to_numpy()
    links = linked @ every["copies"].to_numpy()
    return pd.DataFrame({"rep": ids, "links": links, "root": _roots(ids, linked)})[some]


def _small_blocks(frame: pd.DataFrame, starts: np.ndarray, size: int, threshold: float) -> Iterator[pd.DataFrame]:
    """Links inside many blocks of one size and dimension, as stacks of matrices."""
    dim, tables = int(frame["dim"].iloc[starts[0]]), len(frame["hashes"].iloc[starts[0]])
    step = max(1, CELLS // (size * (dim + size)))
    for first in range(0, len(starts), step):
        at = starts[first : first + step, None] + np.arange(size)
        x, length = _unit(frame["vec"].iloc[at.ravel()])
        x, length = x.reshape(len(at), size, dim), length.reshape(len(at), size)
        linked = x @ x.transpose(0, 2, 1) / (length[:, :, None] * length[:, None, :]) >= threshold
        linked[:, np.arange(size), np.arange(size)] = False
        block, a, b = np.nonzero(linked)
        if not len(block):
            continue
        rows, inverse = np.unique(np.concatenate([at[block, a], at[block, b]]), return_inverse=True)
        hashes = np.stack(frame["hashes"].iloc[rows].to_list())
        same = hashes[inverse[: len(block)]] == hashes[inverse[len(block) :]]
        table = frame["t"].to_numpy()[at[block, 0]]
        earlier = (same & (np.arange(tables) < table[:, None])).any(axis=1)
        linked[block[earlier], a[earlier], b[earlier]] = False
        some = linked.any(axis=2)
        if some.any():
            ids, copies = frame["rep"].to_numpy()[at], frame["copies"].to_numpy()[at]
            links = (linked @ copies[:, :, None])[:, :, 0]
            yield pd.DataFrame({"rep": ids[some], "links": links[some], "root": _roots(ids, linked)[some]})


def _block_links(threshold: float):
    keys = ["t", "bucket", "dim", "kind", "i", "j"]

    def solved(frame: pd.DataFrame, cuts: np.ndarray) -> Iterator[pd.DataFrame]:
        starts, sizes = cuts[:-1], np.diff(cuts)
        within, dims = (frame["i"] == frame["j"]).to_numpy()[starts], frame["dim"].to_numpy()[starts]
        together = within & (sizes <= SMALL)
        for dim, size in np.unique(np.stack([dims[together], sizes[together]]), axis=1).T:
            if size > 1:
                yield from _small_blocks(frame, starts[together & (dims == dim) & (sizes == size)], int(size), threshold)
        for start, size in zip(starts[~together], sizes[~together]):
            yield _large_block(frame.iloc[start : start + size], threshold)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the last block so far, which the next batch may go on with
        for batch in batches:
            if batch.empty:
                continue
            if held and (held[-1][keys].iloc[-1] == batch[keys].iloc[-1]).all():
                held.append(batch)
                continue
            frame = pd.concat([*held, batch], ignore_index=True)
            values = frame[keys].to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], (values[1:] != values[:-1]).any(axis=1)]))
            yield from solved(frame, cuts)
            held = [frame.iloc[cuts[-1] :]]
        if held:
            last = pd.concat(held, ignore_index=True)
            yield from solved(last, np.array([0, len(last)]))

    return work


def near_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    bits: int | None = None,
    miss: float = MISS,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Rows with equal, non-null labels and equal length link when their cosine in double precision is at
    least ``threshold``. Equal vectors are one class first. Each class gets one sign hash per table;
    ``bits`` grow with the logarithm of the rows unless they are given, and the number of tables follows so
    that a pair at the threshold stays unseen with probability ``miss`` at most. Buckets are cut into chunks of about
    ``block`` classes and all pairs of chunks are compared as matrices, in many tasks; what leaves a task
    is one count and one edge per class, never its pairs. A pair counts in the first table it shares.

    Null, empty, all-zero vectors and such with null or non-finite components, null labels and null ids
    link with nothing: 0 links, their own component, kept. Rows that repeat an id are rows of their own.
    An empty table gives no rows; other columns are ignored.
    """
    vec, label = F.col(vec_col), F.col(label_col)
    base = rows.select(
        F.col(id_col).cast("long").alias("id"), vec.alias("vec"), label.alias("label"),
        (usable(vec) & label.isNotNull() & F.col(id_col).isNotNull()).alias("ok"),
    ).withColumn("k1", F.when(F.col("ok"), F.xxhash64("label", "vec"))).withColumn(
        "k2", F.when(F.col("ok"), F.xxhash64(F.lit(seed), "vec", "label"))
    )
    every, seen = stored_with(base.select("id", "ok", "k1", "k2"), "vectors", able=F.count_if("ok"))
    bits = bits or bits_for(seen["able"])
    tables = tables_needed(threshold, bits, miss)
    classes = stored(
        base.filter("ok").groupBy("k1", "k2").agg(
            F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("vec").alias("vec"), F.first("label").alias("label")
        ).withColumn("hashes", _hasher(tables, bits, seed)("vec")).withColumn("dim", F.size("vec")).withColumn(
            "kind", F.xxhash64("label")),
        "classes",
    )
    bucket = ["t", "bucket", "dim", "kind"]
    placed = classes.select("k1", "k2", "dim", "kind", F.posexplode("hashes").alias("t", "bucket"))
    crowded = apart(placed.groupBy(*bucket).agg(F.count("*").alias("n")).filter("n > 1"), *bucket)
    chunks = F.ceil(F.col("n") / block)
    member = (
        placed.join(crowded, bucket)
        .select("k1", "k2", *bucket, F.pmod(F.xxhash64(F.lit(seed), "k1", "k2"), chunks).cast("int").alias("chunk"), chunks.cast("int").alias("chunks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("k1", "k2", *bucket, "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    )
    wide = member.join(classes.select("k1", "k2", "rep", "copies", "vec", "hashes"), ["k1", "k2"]).drop("k1", "k2")
    keys = [*bucket, "i", "j"]
    found = stored(wide.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(frugal(_block_links(threshold)), OUT), "links")
    roots = connected_components(found.select("rep", "root"), "rep", "root")
    totals = found.groupBy("rep").agg(F.sum("links").alias("links"))
    solved = stored(
        classes.select("k1", "k2", "rep", "copies").join(totals, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("component")),
        "solved",
    )
    for done in (found, roots, classes):
        forget(done)
    linked = every.filter("ok").join(solved, ["k1", "k2"]).select("id", "links", "component")
    alone = every.filter("NOT ok").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    return linked.unionByName(alone).select(
        F.col("id").alias("vec_id"), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
