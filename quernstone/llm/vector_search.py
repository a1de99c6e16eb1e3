"""Exact top-k search by a vector-approximation file: cells give bounds, exact vectors settle the rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quernstone.llm.common import key_runs

SCALE = 1024
LARGEST = 1 << 26
LONG = (1 << 63) - 1
GROUP_PARTS = 8
CELLS = 256
BLOCK_ROWS = 32_768
QUERY_ROWS = 2_048
STEP = 64
OUT = "query_id long, vec_id long, score long, wide boolean"


def usable(vector: Column) -> Column:
    """Components as doubles; null where the vector takes no part."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(F.coalesce(~odd, F.lit(False)) & (F.size(vector) > 0), vector.cast("array<double>"))


def _integers(x: np.ndarray) -> np.ndarray:
    """Whole doubles as Python integers, of any size."""
    return np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)


def _ranked(ids: np.ndarray, lower: np.ndarray, upper: np.ndarray, exact, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of some rows by exact score, read in order of their upper bounds until the rest cannot reach them."""
    wanted = np.arange(len(ids))
    if len(wanted) > k:
        floor = np.partition(lower, len(wanted) - k)[len(wanted) - k]
        wanted = wanted[upper >= floor]
    wanted = wanted[np.argsort(-upper[wanted], kind="stable")]
    scores, seen = exact(wanted[:0]), 0
    while seen < len(wanted):
        if seen >= k and upper[wanted[seen]] < np.sort(scores)[seen - k]:
            break
        scores = np.concatenate([scores, exact(wanted[seen : seen + STEP])])
        seen = len(scores)
    own = ids[wanted[:seen]]
    best = np.lexsort((own, -scores))[:k]
    return own[best], scores[best]


class _Wide:
    """Vectors whose scores may leave 64 bits: bounds by doubles, scores by integers of any size."""

    def __init__(self, ids: np.ndarray, exact: np.ndarray):
        self.ids, self.exact = ids, exact

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        other = self.ids != query_id
        ids, rows = self.ids[other], self.exact[other]
        near, slack = rows @ query, np.abs(rows) @ np.abs(query) * 1e-9 + 1
        whole = _integers(query[None, :])[0]
        return _ranked(ids, near - slack, near + slack, lambda at: _integers(rows[at]) @ whole if len(at) else np.empty(0, dtype=object), k)


class _Cells:
    """One block of vectors: coarse cells for bounds, exact components beside them."""

    def __init__(self, ids: np.ndarray, exact: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.exact = ids[order], exact[order].astype(np.int64)
        low, high = int(self.exact.min()), int(self.exact.max())
        self.width = 1
        while (high - low) // self.width >= CELLS:
            self.width *= 2
        self.low = low
        self.cell = ((self.exact - low) // self.width).astype(np.uint8)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        corner = self.cell.astype(np.float64) * self.width + self.low
        q = queries.astype(np.float64)
        least = q @ corner.T
        slack = self.width - 1
        up, down = slack * np.maximum(q, 0).sum(axis=1), slack * np.minimum(q, 0).sum(axis=1)
        sure = np.abs(q).sum(axis=1) * np.abs(corner).max() * 1e-12 + 1
        for at, query in enumerate(query_ids):
            other = self.ids != query
            ids, rows = self.ids[other], self.exact[other]
            lower, upper = least[at][other] + down[at] - sure[at], least[at][other] + up[at] + sure[at]
            yield _ranked(ids, lower, upper, lambda i, rows=rows, q=queries[at]: rows[i] @ q, k)


class _Block:
    """The vectors of a block: those of common size in cells, the others beside them."""

    def __init__(self, ids: np.ndarray, exact: np.ndarray):
        small = (np.abs(exact) < LARGEST).all(axis=1)
        self.cells = _Cells(ids[small], exact[small]) if small.any() else None
        self.wide = _Wide(ids[~small], exact[~small]) if not small.all() else None
        self.every = _Wide(ids, exact)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[pd.DataFrame]:
        small = (np.abs(queries) < LARGEST).all(axis=1)
        found = iter(self.cells.search(query_ids[small], queries[small].astype(np.int64), k) if self.cells else ())
        for query_id, query, common in zip(query_ids, queries, small):
            if not common:
                parts = [self.every.search(query_id, query, k)]
            else:
                parts = [next(found)] if self.cells else []
                if self.wide:
                    parts.append(self.wide.search(query_id, query, k))
            for ids, scores in parts:
                whole = scores.astype(object)
                wide = np.array([not -LONG <= v <= LONG for v in whole], dtype=bool)
                fit = np.array([max(-LONG, min(LONG, int(v))) for v in whole], dtype=np.int64)
                yield pd.DataFrame({"query_id": np.full(len(ids), query_id), "vec_id": ids, "score": fit, "wide": wide})


def _search(k: int, scale: int):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, place = None, None
        for run in key_runs(batches, ["dim", "block", "grp", "part"]):
            vectors, here = np.floor(np.stack(run["vec"].to_list()) * scale), (run["dim"].iloc[0], run["block"].iloc[0], run["grp"].iloc[0])
            if run["part"].iloc[0] < 0:
                block, place = _Block(run["id"].to_numpy(), vectors), here
                continue
            if place != here:  # no vector of this length in the block
                continue
            yield from block.search(run["id"].to_numpy(), vectors, k)

    return work


def top_k_inner(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of ``floor(scale * x)``.

    Both tables have the same columns. Vectors lie in blocks of about ``block_rows``; every query visits
    every block once, in parts of ``query_rows``. Inside a block the quantised cells (a byte per
    component) bound each score from both sides; exact vectors are read in order of their bound, until
    no unread one can reach the best ``k``. Blocks return ``k`` rows per query, which a windowed rank
    merges. Queries travel once per block, vectors once per ``GROUP_PARTS`` parts, so no task has more
    than a block and so many queries, however long the table is.

    Ties go to the smaller id. Rows with the query's id are its own and never candidates. Null or empty
    vectors, null ids, null or non-finite components take no part. Components of 65,536 or more go by
    integers of any size; a score among the best ``k`` that no long can hold is an error. Vectors of other
    lengths are no candidates. Empty tables give no rows; other columns are ignored.
    """
    def shaped(df: DataFrame) -> DataFrame:
        narrow = df.select(F.col(id_col).cast("long").alias("id"), usable(F.col(vec_col)).alias("vec"))
        return narrow.filter("id IS NOT NULL AND vec IS NOT NULL").withColumn("dim", F.size("vec"))

    blocks = max(1, -(-rows.count() // block_rows))
    parts = max(1, -(-queries.count() // query_rows))
    groups = -(-parts // GROUP_PARTS)
    stored_side = (
        shaped(rows).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("part", F.lit(-1))
        .withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    )
    asking = (
        shaped(queries)
        .withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
        .withColumn("grp", F.expr(f"part DIV {GROUP_PARTS}").cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .select("id", "vec", "dim", "block", "part", "grp")
    )
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (
        stored_side.unionByName(asking)
        .repartition(tasks, "dim", "block", "grp")
        .sortWithinPartitions("dim", "block", "grp", "part")
        .mapInPandas(_search(k, scale), OUT)
    )
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    fits = F.when(F.col("wide"), F.raise_error(F.lit("a score is too large for a long integer"))).otherwise(F.col("score"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", fits.alias("score"))
