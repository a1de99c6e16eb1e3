"""Metric files, run logs and run records."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.session import forget, remove, stored

# Characters that Spark escapes in the name of a folder, and its name for none.
ESCAPED = r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]"""
NO_NAME = "__HIVE_DEFAULT_PARTITION__"

METRIC_SCHEMA = """file string, model string, bleu double, rougeL double, loss double, perplexity double,
 Subset string, Hardware string, `Infra (s)` double, `Cleaning (s)` double, Tokenizer string,
 `Mean Epoch (s)` string"""


def read_metrics(spark: SparkSession, path: str, schema: str = METRIC_SCHEMA) -> DataFrame:
    """Files that each hold one JSON array of metric rows; absent fields come out null."""
    return spark.read.option("multiLine", True).schema(schema).json(path)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """One row per log file: ``path, content``."""
    logs = spark.read.text(path, wholetext=True)
    return logs.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Log files line by line: ``path, line``; a log of any size is read in splits."""
    logs = spark.read.text(path)
    return logs.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def write_run_files(files: DataFrame, path: str) -> int:
    """Write ``name, json, log`` as ``<name>.json`` and ``<name>.log`` below ``path``; returns how many files.

    Tasks write to a hidden folder beside them. When all have succeeded, each file is moved to its
    name, which takes its place in one step and replaces an older one; if any fails, the folder is
    removed and nothing appears. Works on every file system that Spark writes to; where that is a
    mounted one, tasks write and move the files themselves.
    """
    hadoop, conf = files.sparkSession._jvm.org.apache.hadoop.fs, files.sparkSession._jsc.hadoopConfiguration()
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    try:
        if hadoop.Path(path).getFileSystem(conf).getUri().getScheme() == "file":
            return _write_mounted(files, *[hadoop.Path(p).toUri().getPath() for p in (path, staging)])
        return _write_remote(files, path, staging)
    finally:
        remove(files.sparkSession, staging)


def _write_mounted(files: DataFrame, path: str, staging: str) -> int:
    """Two jobs: one writes each file to a folder of its task attempt, the other moves those of attempts that succeeded."""
    os.makedirs(staging, exist_ok=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = f"{staging}/{uuid.uuid4().hex}"
        os.makedirs(folder)
        made = 0
        for batch in batches:
            pairs: list[tuple[str, str]] = []
            for name, *texts in zip(*[batch.column(c).to_pylist() for c in ("name", "json", "log")]):
                shown = re.sub(ESCAPED, lambda c: f"%{ord(c[0]):02X}", name) if name else NO_NAME
                for kind, text in zip(("json", "log"), texts):
                    staged, made = f"{folder}/{made}", made + 1
                    with open(staged, "w", encoding="utf-8", newline="") as out:
                        out.write((text or "") + "\n")
                    pairs.append((staged, f"{shown}.{kind}"))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*pairs)] or [pa.array([], pa.string())] * 2, names=["staged", "target"])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for staged, target in zip(*[batch.column(c).to_pylist() for c in ("staged", "target")]):
                checksum = f"{path}/.{target}.crc"  # of an older file that Hadoop wrote
                if os.path.exists(checksum):
                    os.remove(checksum)
                if os.path.exists(staged) or not os.path.exists(f"{path}/{target}"):  # else an earlier attempt moved it
                    os.replace(staged, f"{path}/{target}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    made = stored(files.select("name", "json", "log").mapInArrow(write, "staged string, target string"), "run-files")
    try:
        return made.mapInArrow(move, "n long").agg(F.sum("n")).first()[0] or 0
    finally:
        forget(made)


def _write_remote(files: DataFrame, path: str, staging: str) -> int:
    """Files by Spark's writer, a folder each, moved by the driver."""
    spark = files.sparkSession
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    both = F.inline(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("value")) for kind in ("json", "log")]))
    files.select("name", both).write.option("maxRecordsPerFile", 1).partitionBy("name", "kind").text(staging)
    system = hadoop.Path(path).getFileSystem(conf)
    made = list(system.globStatus(hadoop.Path(f"{staging}/name=*/kind=*/part-*")) or [])
    for status in made:
        part = status.getPath()
        kind, name = part.getParent(), part.getParent().getParent()
        target = hadoop.Path(f"{path}/{name.getName().removeprefix('name=')}.{kind.getName().removeprefix('kind=')}")
        system.delete(target, False)
        if not system.rename(part, target):
            raise OSError(f"{target} could not be put in place")
    return len(made)


def read_run_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records from the ``.json`` files below ``path``, one each."""
    return spark.read.option("multiLine", True).option("pathGlobFilter", "*.json").schema(schema).json(path)


def write_log_texts(logs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One text file per row with the row's ``content``."""
    logs.select("content").write.mode(mode).option("maxRecordsPerFile", 1).text(path)
