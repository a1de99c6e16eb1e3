"""Subsets, samples, batches and audit suites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quernstone.operators.positions import positions_in_order, shuffle_key

# Rows scored per evaluation depth, and the share of the validation budget.
SCORING_BUDGETS = {"instant": 100, "fast": 200, "deep": 1000}
VALID_SHARE = 5

TASK_GROUPS = 256


def valid_budget(subset: int) -> int:
    return subset // VALID_SHARE


def subset_first_n(rows: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    """The first ``n`` rows by a unique id of any sortable type, for any ``n``.

    A plain top-n would send ``n`` rows of every task to one task. Here the ids alone are cut into ranges
    and counted; the ``n``-th id then is a bound that filters the rows where they are.
    """
    placed, _ = positions_in_order(rows.select(id_col), [id_col])
    bound = placed.filter(F.col("pos") <= n).agg(F.max(id_col).alias("bound"))
    return rows.filter(F.col(id_col) <= bound.scalar())


def first_n_per_group(rows: DataFrame, n: int, by: str, id_col: str = "id") -> DataFrame:
    """The first ``n`` rows of each group; every task keeps at most ``n`` per group before they meet."""
    rank = F.row_number().over(W.partitionBy(by).orderBy(id_col))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def sample_n_per_split(
    rows: DataFrame, n: int = 10, seed: int = 0, split: str = "split", id_col: str = "id"
) -> DataFrame:
    """``min(n, size)`` rows per split, drawn by a seeded hash of the id.

    Each task keeps its own best ``n`` per split, groups of tasks then agree on theirs, and only
    the winners of the groups meet in one place.
    """
    keyed = rows.withColumn("_key", shuffle_key(id_col, seed)).withColumn("_group", F.spark_partition_id() % TASK_GROUPS)
    for group in ([split, "_group"], [split]):
        rank = F.row_number().over(W.partitionBy(*group).orderBy("_key", id_col))
        keyed = keyed.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
    return keyed.drop("_key", "_group")


def assign_batches(
    rows: DataFrame, batch_size: int, seed: int | None = None, id_col: str = "id"
) -> DataFrame:
    """Number consecutive groups of ``batch_size`` rows from 0, in id order or shuffled by a seed.

    Ids may be of any sortable type, such as the (file, block, line) of refined shards.
    """
    if seed is None:
        placed, _ = positions_in_order(rows, [id_col])
    else:
        placed, _ = positions_in_order(rows.withColumn("_key", shuffle_key(id_col, seed)), ["_key", id_col])
        placed = placed.drop("_key")
    return placed.withColumn("batch_id", F.expr(f"(pos - 1) DIV {batch_size}"))


def audit_suites(rows: DataFrame, custom: DataFrame, n: int = 10, seed: int = 0) -> DataFrame:
    """Tagged samples for a qualitative audit: training rows, test rows and hand-written rows.

    ``custom`` has ``id, code, docstring``. A suite without rows simply adds none.
    """
    sample = sample_n_per_split(rows.filter(F.col("split").isin("train", "test")), n, seed)
    columns = ("suite", "id", "code", "docstring")
    return (
        sample.withColumn("suite", F.col("split"))
        .select(*columns)
        .unionByName(custom.withColumn("suite", F.lit("custom")).select(*columns))
    )
