"""The whole refinery as a job: clean once, store, decide on narrow rows, write and report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quernstone.operators import refine as ops
from quernstone.session import stored
from quernstone.sources import jsonl


def store_gated(pairs: DataFrame, *columns: str, **bands: tuple[int, int]) -> DataFrame:
    """Write the rows that pass the gates once, all or some of their columns, and hand back the table.

    Cleaning is the costly part. Readers of the result scan only the columns they need, and a lost
    executor costs a re-read.
    """
    gated = ops.gate_pairs(pairs, **bands)
    return stored(gated.select(*columns) if columns else gated, "gated")


def store_judged(pairs: DataFrame, **bands: tuple[int, int]) -> DataFrame:
    """The verdict of the gates for every row, without text: ``id, split, reason, fp``."""
    return stored(ops.judge_pairs(pairs, **bands).select("id", "split", "reason", "fp"), "judged")


def _keep(gated: DataFrame) -> DataFrame:
    """Refined rows of a stored table.

    Which rows stay is decided without their text. The text then meets the kept ids, which are unique,
    so a fingerprint that half of the rows share never brings their texts together.
    """
    kept = stored(ops.kept_ids(gated.select("id", "split", "fp")), "kept")
    return gated.join(kept, "id", "left_semi").select("id", "split", "code", "docstring")


def refine_stored(pairs: DataFrame, **bands: tuple[int, int]) -> DataFrame:
    """Same rows as :func:`quernstone.operators.refine.refine`, cleaning every text only once."""
    return _keep(store_gated(pairs, **bands))


def refine_shards(spark: SparkSession, root: str, out: str, shards: str = jsonl.SHARDS) -> DataFrame:
    """Raw shards under ``root`` to refined shards under ``out``; returns the audit per split."""
    lines = jsonl.read_jsonl_shards(spark, root, shards=shards)
    records = jsonl.normalize_keys(lines)
    judged = stored(ops.judge_pairs(records.withColumn("id", ops.order_key("file", "block", "seq"))), "judged")
    jsonl.write_refined(_keep(ops.passed(judged)), out)
    return ops.refinery_audit(judged)
