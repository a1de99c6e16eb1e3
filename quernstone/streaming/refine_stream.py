"""The refinery over shards that keep arriving."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quernstone.operators import refine as ops
from quernstone.sources import jsonl


SALTS = 8
KEPT = ["split", "code", "docstring", "fp"]
ROW = "split string, code string, docstring string, fp string"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _keep_state_on_disk(spark: SparkSession) -> None:
    """Seen fingerprints are kept for good, so they must not have to fit into memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def stream_shards(spark: SparkSession, root: str, shards: str = jsonl.SHARDS) -> DataFrame:
    """Lines of the shards below ``root`` as a stream of ``split, file, raw``."""
    lines = spark.readStream.option("pathGlobFilter", shards).option("recursiveFileLookup", True).text(root)
    file = F.col("_metadata.file_path")
    return lines.select(jsonl.split_of(file, root).alias("split"), file.alias("file"), F.col("value").alias("raw"))


def gate_stream(lines: DataFrame) -> DataFrame:
    """Gated rows ``id, split, code, docstring, fp`` of a stream of raw lines; the id is the file."""
    return ops.gate_pairs(jsonl.normalize_keys(lines.withColumnRenamed("file", "id")))


def _first_copies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Training rows once per batch of a task, with markers for the other salts; evaluation rows under a salt each."""
    for rows in batches:
        train = rows[rows["split"] == ops.TRAIN].drop_duplicates("fp")
        other = rows[rows["split"] != ops.TRAIN]
        yield train.assign(salt=0)
        for salt in range(1, SALTS):
            yield train.assign(salt=salt, code=None, docstring=None)
        yield other.assign(salt=np.arange(len(other)) % SALTS)


def _judge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The first training row ever of a fingerprint, or the evaluation rows of one that training does not have."""
    if state.exists:
        return
    held: list[pd.DataFrame] = []
    for rows in batches:
        train = rows["split"].to_numpy() == ops.TRAIN
        if train.any():
            state.update((True,))
            if key[1] == 0:
                at = train.argmax()
                yield rows.iloc[at : at + 1][KEPT]
            return
        held.append(rows[KEPT])
    yield from held


def refine_stream(lines: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """The refinery over arriving lines: each training fingerprint once, and evaluation rows that training does not have.

    Fingerprints seen in training are a keyed state, which a batch asks for its own keys; what it
    reads and writes depends on the batch and not on what came before. An evaluation row meets the
    training rows of its own batch and of all earlier ones. Copies of a training row are dropped in
    each task before they move. Evaluation rows of one fingerprint are dealt over ``SALTS`` keys, each of
    which knows the training fingerprints, so a frequent one is no single task's. Rows lie below ``out``
    by split.
    """
    _keep_state_on_disk(lines.sparkSession)
    gated = gate_stream(lines).select(*KEPT)
    return (
        gated.mapInPandas(_first_copies, f"{ROW}, salt int")
        .groupBy("fp", "salt").applyInPandasWithState(_judge, ROW, "seen boolean", "append", GroupStateTimeout.NoTimeout)
        .writeStream.format("parquet")
        .partitionBy("split")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_stream_output(spark: SparkSession, out: str) -> DataFrame:
    """``split, code, docstring, fp`` of all that :func:`refine_stream` has written so far."""
    return spark.read.schema(ROW).parquet(out)
