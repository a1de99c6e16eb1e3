"""Line deduplication by overlapping windows of three lines."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import apart, stored

WINDOW = 3
# Fixed value: what makes a line count.
VISIBLE = r"[^\x20\x09-\x0D]"
LAST = (1 << 63) - 1


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.struct("*").alias("_row"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("_doc"),
        F.xxhash64(F.lit("text"), text).alias("_copy"),
    )


def _windows(text: Column, window: int) -> tuple[Column, Callable[[Column], Column]]:
    """Two hashes of every visible line, and what makes windows of them: two hashes and the first line's number."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(VISIBLE))
    pairs = F.transform(lines, lambda line: F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b")))

    def at(hashes: Column, j: Column) -> Column:
        own = F.slice(hashes, j + 1, F.lit(window))
        return F.struct(F.xxhash64(own["a"]).alias("h1"), F.xxhash64(F.lit("window"), own["b"]).alias("h2"), j.alias("j"))

    return pairs, lambda hashes: F.when(
        F.size(hashes) >= window, F.transform(F.sequence(F.lit(0), F.size(hashes) - window), lambda j: at(hashes, j))
    )


def _without(window: int):
    @F.pandas_udf("struct<text:string,lines:long,removed:long>")
    def cut(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
        out, total, gone = [], [], []
        for text, begins in zip(texts, starts):
            lines = text.split("\n")
            visible = np.array([k for k, line in enumerate(lines) if line.strip(" \t\n\v\f\r")], dtype=np.int64)
            covered = np.zeros(len(visible) + 1, dtype=np.int64)
            np.add.at(covered, np.asarray(begins), 1)
            np.add.at(covered, np.asarray(begins) + window, -1)
            drop = set(visible[np.cumsum(covered[:-1]) > 0].tolist())
            out.append("\n".join(line for k, line in enumerate(lines) if k not in drop))
            total.append(len(visible))
            gone.append(len(drop))
        return pd.DataFrame({"text": out, "lines": total, "removed": gone})

    return cut


def drop_repeated_lines(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_row`` (the document as a struct, its text without repeats), ``n_lines, n_removed`` per document.

    Lines end at line feeds and count if they hold anything visible. Every ``window`` consecutive lines
    form a window, known by 128 bits of hash. Of all windows with the same lines in the whole table the
    first by (id, position) stays; the lines that any other of them covers go, blank lines stay where
    they are. A removed line always has an earlier, equal line that stays.

    Windows are reduced to their first place inside each task before they move; only windows that occur
    again are joined to their occurrences, as two stored narrow tables, so that one passage in a third
    of all documents is split over tasks. Texts meet nothing but the positions to cut.

    Texts of fewer lines, empty and null ones stay as they are. Null ids come last. Rows that repeat both
    id and text count as one document and stay alike. Empty tables give no rows.
    """
    keyed, text = _keyed(docs, id_col, text_col), F.col(f"_row.`{text_col}`")
    pairs, windows = _windows(text, window)
    places = stored(
        keyed.select("_doc", "_copy", pairs.alias("hashes"))
        .select("_doc", "_copy", F.explode(windows(F.col("hashes"))).alias("w"))
        .select("w.h1", "w.h2", F.struct("_doc", "_copy", F.col("w.j").alias("j")).alias("place")),
        "windows",
    )
    again = apart(
        places.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.max("place").alias("last")).filter("first <> last")
        .select("h1", "h2", "first"),
        "h1", "h2",
    )
    later = (
        places.join(again, ["h1", "h2"]).filter("place > first")
        .groupBy("place._doc", "place._copy").agg(F.sort_array(F.collect_set("place.j")).alias("starts"))
    )
    joined = keyed.join(later, ["_doc", "_copy"], "left")
    hit = F.col("starts").isNotNull()
    cut = _without(window)(F.when(hit, text).otherwise(F.lit("")), F.coalesce("starts", F.array().cast("array<int>")))
    own = F.coalesce(F.size(F.filter(F.split(text, "\n"), lambda line: line.rlike(VISIBLE))), F.lit(0))
    return joined.withColumn("_cut", cut).select(
        F.col("_row").withField(f"`{text_col}`", F.when(hit, F.col("_cut.text")).otherwise(text)).alias("_row"),
        F.when(hit, F.col("_cut.lines")).otherwise(F.when(text.isNull(), 0).otherwise(own)).cast("long").alias("n_lines"),
        F.when(hit, F.col("_cut.removed")).otherwise(0).cast("long").alias("n_removed"),
    )
