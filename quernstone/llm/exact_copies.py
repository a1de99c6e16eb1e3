"""Exact copies of texts by progressive refinement: length, then prefix, then the whole; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import apart, forget, stored, stored_with

PREFIX = 64
SLOTS = 1 << 17
HOT = 1000
# Runs of blanks that are not one space already: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """``text`` with every run of blanks as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def _shape(text: Column) -> list[Column]:
    return [F.octet_length(text).alias("length"), F.xxhash64(F.substring(text, 1, PREFIX)).alias("prefix")]


def _place(slots: int) -> Column:
    return F.pmod(F.xxhash64("length", "prefix"), F.lit(64 * slots))


def _suspects(texts: DataFrame) -> DataFrame:
    """``length, prefix`` that several texts share; texts of a length of their own never reach the second step."""
    shapes = stored(texts.select(*_shape(F.col("text"))), "shapes")
    lengths = stored(shapes.groupBy("length").count().filter("count > 1").select("length"), "lengths")
    found = stored(shapes.join(apart(lengths, "length"), "length").groupBy("length", "prefix").count().filter("count > 1").select("length", "prefix"), "suspects")
    forget(shapes)
    forget(lengths)
    return found


def _marks(suspects: DataFrame, slots: int) -> DataFrame:
    """A bit per suspect, in ``slots`` words of 64 bits: a table of a fixed greatest size, however many suspects."""
    placed = suspects.select(_place(slots).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("at", F.lit(64)).cast("int"))
    return placed.groupBy(F.floor(F.col("at") / 64).alias("slot")).agg(F.bit_or(bit).alias("bits"))


def exact_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False, slots: int = SLOTS
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row for every row of ``docs``.

    Texts are equal when they are after every run of blanks has become one space. Rows are told apart
    by length first, those that share it by a hash of their first ``PREFIX`` characters, and only texts
    that still have a rival are hashed as a whole. What the first two steps leave is a set of (length,
    prefix) keys; it marks bits in a table of ``slots`` words, small enough to send to every task, so
    the last step finds its texts while it scans and no text is ever moved. A bit marked by another key
    costs one needless hash and no error: groups are formed by whole hashes alone. ``digests`` has the
    settled texts hashed too, for callers that want the column filled; else it is null there.

    Groups of more than one row in ``HOT`` are fewer than that many and go to every task; the others are
    joined by hash, so no copy count makes a heavy task.

    Null texts are empty ones, and equal each other. The row with the smallest id of a group stays; rows
    that share that id as well as the text all stay, as nothing tells them apart. Null ids are never the
    smallest while there are others; a group of null ids alone keeps all. Texts of any length are read
    whole. An empty table gives no rows; other columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("text"))
    suspects = _suspects(texts)
    marks = F.broadcast(stored(_marks(suspects, slots), "marks"))
    shaped = texts.select("doc_id", "text", *_shape(F.col("text"))).withColumn("at", _place(slots))
    probed = shaped.withColumn("slot", F.floor(F.col("at") / 64)).join(marks, "slot", "left")
    marked = F.coalesce(F.getbit("bits", F.pmod("at", F.lit(64)).cast("int")) == 1, F.lit(False))
    wanted = F.lit(True) if digests else F.col("suspect")
    hashed, seen = stored_with(
        probed.select("doc_id", "text", marked.alias("suspect")).select("doc_id", "suspect", F.when(wanted, F.sha2(F.col("text").cast("binary"), 256)).alias("sha")),
        "hashed", rows=F.count("*"),
    )
    forget(suspects)
    rivals = hashed.filter("suspect")
    groups = stored(rivals.groupBy("sha").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1"), "groups")
    large = F.col("group_size") > max(seen["rows"] // HOT, 1)
    hot = F.broadcast(groups.filter(large))
    columns = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")]
    alone = [F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")]
    settled = hashed.filter("NOT suspect").select("doc_id", "sha", *alone).select(*columns)
    crowd = rivals.join(hot, "sha").select(*columns)
    others = rivals.join(hot.select("sha"), "sha", "left_anti").join(groups.filter(~large), "sha", "left")
    few = others.select("doc_id", "sha", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size")).select(*columns)
    return settled.unionByName(crowd).unionByName(few)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    gone = stored(exact_classes(docs, id_col, text_col).filter("NOT kept").select("doc_id", "text_sha256").distinct(), "gone")
    keyed = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("doc_id"), F.sha2(normalised(F.col(text_col)).cast("binary"), 256).alias("sha"))
    same = keyed["doc_id"].eqNullSafe(gone["doc_id"]) & (keyed["sha"] == gone["text_sha256"])
    return keyed.join(gone, same, "left_anti").select("_row.*")
