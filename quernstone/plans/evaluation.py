"""Scoring runs end to end: choose rows, predict with every run, store, report."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.operators import quality, sampling
from quernstone.session import stored

KEPT = ("id", "docstring")


def _stored_predictions(rows: DataFrame, store: str) -> DataFrame | None:
    """What the store holds, or nothing where it does not exist yet."""
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in KEPT)
    try:
        return rows.sparkSession.read.schema(f"{kept}, {quality.OUTPUT_SCHEMA}, file string").parquet(store)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def predict_missing(rows: DataFrame, scorers: Mapping[str, Callable[[], quality.Scorer]], store: str) -> DataFrame:
    """The predictions of all runs for ``rows`` (unique ``id``, ``code``, ``docstring``), from ``store`` where it has them.

    The store is a table by run and id. What it lacks is predicted in one pass over the rows, which calls
    each scorer for the rows its run lacks and for no others, and appended; a row that failed counts as
    predicted. A pass that breaks off leaves the store as it was.
    """
    files = list(scorers)
    known = _stored_predictions(rows, store)
    asked = rows.select("id", "code", "docstring")
    if known is None:
        missing = quality.predict_runs(asked, scorers, KEPT)
    else:
        had = known.filter(F.col("file").isin(files)).groupBy("id").agg(F.collect_set("file").alias("_done"))
        lacking = asked.join(had, "id", "left").filter(F.coalesce(F.size("_done"), F.lit(0)) < len(files))
        missing = quality.predict_runs(lacking, scorers, KEPT, "_done")
    missing.write.mode("append").partitionBy("file").parquet(store)
    return _stored_predictions(rows, store).filter(F.col("file").isin(files)).join(asked.select("id"), "id", "left_semi")


def evaluate(
    rows: DataFrame, scorers: Mapping[str, Callable[[], quality.Scorer]], budget: int | None = None, stemmed: bool = True,
    store: str | None = None,
) -> DataFrame:
    """Report with one row per run over ``rows`` (``id, code, docstring``), or the first ``budget`` of them.

    ``scorers`` maps the file of each run to its scorer; every run is scored on the same rows, which are
    read once for all. Predictions are stored before they are scored: the scorer is the costly part, and
    both scores read its output. With a ``store`` of the caller's a later call predicts only what is
    missing there (see :func:`predict_missing`).
    """
    chosen = rows if budget is None else stored(sampling.subset_first_n(rows, budget), "chosen")
    if store is None:
        predicted = stored(quality.predict_runs(chosen, scorers, KEPT), "predictions")
    else:
        predicted = predict_missing(chosen, scorers, store)
    return quality.evaluation_report(predicted, "file", stemmed)
