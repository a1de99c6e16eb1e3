"""Directory trees of source files as a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Directories left out of every index.
IGNORED_DIRS = ("__pycache__", ".git", ".idea", "venv", "Datasets")


def read_source_files(
    spark: SparkSession,
    root: str,
    ignore: Sequence[str] = IGNORED_DIRS,
    extension: str = ".py",
) -> DataFrame:
    """``path`` (relative), ``depth``, ``length`` in bytes and decoded ``source`` of each file.

    A file is left out when any directory above it (below ``root``) is in ``ignore``. Small files
    are packed into shared splits by the scan.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{extension}")
        .option("recursiveFileLookup", True)
        .load(root)
    )
    below = root.rstrip("/").split(":", 1)[-1] + "/"
    relative = F.substring_index("path", below, -1)
    parts = F.split("_path", "/")
    folders = F.slice(parts, F.lit(1), F.size(parts) - 1)
    ignored = F.arrays_overlap(folders, F.array(*[F.lit(d) for d in ignore]).cast("array<string>"))
    return (
        files.withColumn("_path", relative)
        .filter(~F.coalesce(ignored, F.lit(False)))
        .select(
            F.col("_path").alias("path"),
            F.size(parts).alias("depth"),
            "length",
            F.decode("content", "UTF-8").alias("source"),
        )
    )
