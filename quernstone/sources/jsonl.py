"""Sharded gzip JSON lines: reading, key normalisation, malformed lines, writing, preview."""

from __future__ import annotations

import logging
import re
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions.text import strip_ws

log = logging.getLogger(__name__)

SPLITS = ("train", "valid", "test")
SHARDS = "*.jsonl.gz"
SHARD_SCHEMA = "split string, file string, block bigint, seq bigint, raw string"

# Key names of the two record layouts, refined name first.
CODE_KEYS = ("code", "func_code_string")
DOC_KEYS = ("docstring", "func_documentation_string")


def split_of(file: Column, root: str) -> Column:
    """Split of a shard by the nearest split folder below ``root``; fails for a shard that lies in none."""
    below = quote(re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/") + "/", safe="/:")
    inside = F.when(F.locate(below, file) > 0, F.substr(file, F.locate(below, file) + len(below) - 1)).otherwise(file)
    nearest = F.regexp_extract(inside, rf"(?s)^.*/(?:split=)?({'|'.join(SPLITS)})/", 1)
    stray = F.raise_error(F.concat(F.lit("shard lies in no split folder: "), file))
    return F.when(nearest != "", nearest).otherwise(stray.cast("string"))


def _missing(problem: AnalysisException) -> bool:
    return problem.getCondition() == "PATH_NOT_FOUND"


def read_jsonl_shards(
    spark: SparkSession, root: str, split: str | None = None, shards: str = SHARDS
) -> DataFrame:
    """Every line of every shard below ``root``: ``split, file, block, seq, raw``.

    Splits are directories named ``train`` or ``split=train``. ``(file, block, seq)`` sorts lines in
    file order without numbering them: one task reads a block front to back, so the increasing id
    it hands out is ordered inside the block. A root or split without shards gives a warning and no
    rows; a shard outside any split folder is an error, as are paths that cannot be read.
    """
    path = f"{root}/{{{split},split={split}}}" if split else root
    try:
        lines = (
            spark.read.option("pathGlobFilter", shards)
            .option("recursiveFileLookup", True)
            .text(path)
        )
    except AnalysisException as problem:
        if not _missing(problem):
            raise
        lines = None
    if lines is None or not lines.inputFiles():
        log.warning("no shards %s under %s", shards, path)
        return spark.createDataFrame([], SHARD_SCHEMA)
    file = F.col("_metadata.file_path")
    return lines.select(
        split_of(file, root).alias("split"),
        file.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("raw"),
    )


def _last_value(entries: Column, keys: tuple[str, ...], missing: str | None) -> Column:
    """Value of the first key that is present, even when that value is null."""

    def hits(key: str) -> Column:
        return F.filter(entries, lambda e: e["key"] == key)

    value = F.lit(missing).cast("string")
    for key in reversed(keys):
        last = F.try_element_at(hits(key), F.lit(-1))["value"]
        value = F.when(F.size(hits(key)) > 0, last).otherwise(value)
    return value


def normalize_keys(lines: DataFrame, missing: str | None = "") -> DataFrame:
    """Add ``code``, ``docstring`` and ``malformed`` to a frame with a ``raw`` JSON line.

    The second key name counts only where the first is absent; a present null stays null. Of
    repeated keys the last one counts. Single quotes, cut-off lines, empty lines and JSON that is
    not an object are malformed.
    """
    options = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
    parsed = F.from_json("raw", "map<string,string>", options)
    closed = F.col("raw").rlike(r"\}[ \t\r\n]*$")
    entries = F.map_entries("_record")
    found = lines.withColumn("_record", F.when(closed, parsed)).select(
        *lines.columns,
        _last_value(entries, CODE_KEYS, missing).alias("code"),
        _last_value(entries, DOC_KEYS, missing).alias("docstring"),
        F.col("_record").isNull().alias("malformed"),
    )
    blank = {c: F.when(~F.col("malformed"), F.col(c)) for c in ("code", "docstring")}
    return found.withColumns(blank)


def malformed_records(lines: DataFrame) -> DataFrame:
    """The lines that no record could be read from."""
    return normalize_keys(lines).filter("malformed").select(*lines.columns)


def write_refined(refined: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Gzip JSON lines of ``code`` and ``docstring``, ASCII only, one directory per split."""
    (
        refined.select("split", "code", "docstring")
        .write.mode(mode)
        .partitionBy("split")
        .option("compression", "gzip")
        .option("writeNonAsciiCharacterAsCodePoint", "true")
        .json(path)
    )


# Layout of a preview sample.
SAMPLE_LAYOUT = "--- SAMPLE #%d ---\nTARGET SUMMARY (DOC): %s\nINPUT LOGIC (CODE):\n%s\n" + "-" * 50
SAMPLE_BROKEN = "--- SAMPLE #%d [CRITICAL: JSON DECODE ERROR] ---"


def first_shard(spark: SparkSession, root: str, shards: str = SHARDS) -> str | None:
    """First training shard below ``root`` in order of paths, else the first shard of any kind.

    Folders are listed one by one and no further than the first training shard; no job runs and no
    file is opened. Names that begin with a dot or an underscore are passed over, as in any read.
    """
    fs = spark._jvm.org.apache.hadoop.fs
    path = fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    wanted = fs.GlobFilter(shards)
    pending = sorted((str(found.getPath().toString()) for found in system.globStatus(path) or []), reverse=True)
    if not pending:
        raise FileNotFoundError(root)
    other = None
    while pending:
        status = system.getFileStatus(fs.Path(pending.pop()))
        at, name = status.getPath(), status.getPath().getName()
        if status.isDirectory():
            below = [found.getPath() for found in system.listStatus(at)]
            pending += sorted((p.toString() for p in below if not _hidden(p.getName())), reverse=True)
        elif wanted.accept(at):
            if "train" in name:
                return at.toString()
            other = other or at.toString()
    return other


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def preview(spark: SparkSession, root: str, n: int = 100, shards: str = SHARDS) -> DataFrame:
    """The first ``n`` lines of the first training shard, rendered; a broken line takes a number.

    One task reads the shard from its start and stops behind line ``n``; nothing is sorted or
    exchanged. Without any shard there is a warning and no rows.
    """
    path = first_shard(spark, root, shards)
    if path is None:
        log.warning("no shards %s under %s", shards, root)
        return spark.createDataFrame([], "sample_no int, sample string")
    lines = spark.read.text(path).coalesce(1).limit(n).select(
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("raw")
    )
    head = normalize_keys(lines, missing="N/A")
    text = {c: strip_ws(F.coalesce(F.col(c), F.lit(""))) for c in ("docstring", "code")}
    number = (F.col("seq") + 1).cast("int")
    return head.select(number.alias("sample_no"), "malformed", *[v.alias(k) for k, v in text.items()]).select(
        "sample_no",
        F.when(F.col("malformed"), F.format_string(SAMPLE_BROKEN, "sample_no"))
        .otherwise(F.format_string(SAMPLE_LAYOUT, "sample_no", "docstring", "code"))
        .alias("sample"),
    )
