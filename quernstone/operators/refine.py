"""The corpus refinery: clean, gate, deduplicate the training split, keep it out of the others.

Raw pairs carry ``id`` (the order key), ``split``, ``code`` and ``docstring``. *Judged* rows are all of
them, cleaned, with the gate they failed; *gated* rows are those that passed, with a fingerprint.
Training rows are kept first-come per fingerprint; rows of other splits are dropped when a gated
training row has their fingerprint, and are never compared with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.session import apart

TRAIN = "train"
REASONS = ("removed_len", "removed_dupe", "removed_doc")


def _settled(df: DataFrame) -> DataFrame:
    """Keep later filters above the expressions computed so far.

    Catalyst moves a filter below a projection by copying the projection's expressions into it,
    which would run every cleaning regex once more. It does not move one below a generator, so the
    row passes through a one-element ``inline``.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def order_key(*columns: str) -> Column:
    """Several order columns as one sortable ``id``."""
    return F.struct(*columns)


def _has_summary(doc: Column) -> Column:
    return (doc != "") & T.has_alnum(doc)


def gate_reason(code_band: tuple[int, int] = T.CODE_WORDS, doc_band: tuple[int, int] = T.DOC_WORDS) -> Column:
    """First gate a cleaned row fails, judged on the row alone; null when it passes all of them.

    Short code shares the ``removed_doc`` bucket, and rows without code have a bucket of their own.
    """
    raw, code, doc = F.col("raw_code"), F.col("code"), F.col("docstring")
    band = T.length_band(F.col("code_words"), F.col("doc_words"), code_band, doc_band)
    return (
        F.when(F.col("malformed"), "malformed")
        .when(raw.isNull() | (raw == ""), "no_code")
        .when(~_has_summary(doc), "removed_doc")
        .when(~T.min_chars(code), "removed_doc")
        .when(~band, "removed_len")
    )


def _readable(pairs: DataFrame) -> DataFrame:
    return pairs if "malformed" in pairs.columns else pairs.withColumn("malformed", F.lit(False))


def judge_pairs(
    pairs: DataFrame,
    code_band: tuple[int, int] = T.CODE_WORDS,
    doc_band: tuple[int, int] = T.DOC_WORDS,
) -> DataFrame:
    """Every row with its cleaned text, first failed gate and, if it failed none, fingerprint.

    One projection per step: Catalyst keeps them apart because each expensive column is used more
    than once, so every pattern runs once per row.
    """
    code, doc = F.col("code"), F.col("docstring")
    cleaned = _readable(pairs).select(
        "id", "split", "malformed", code.alias("raw_code"),
        T.clean_code(code).alias("code"), T.clean_docstring(doc).alias("docstring"),
    )
    counted = cleaned.withColumns({"code_words": T.word_count(code), "doc_words": T.word_count(doc)})
    judged = counted.select("id", "split", "code", "docstring", gate_reason(code_band, doc_band).alias("reason"))
    return _settled(judged.withColumn("fp", F.when(F.col("reason").isNull(), T.fingerprint(code))))


def gate_pairs(
    pairs: DataFrame,
    code_band: tuple[int, int] = T.CODE_WORDS,
    doc_band: tuple[int, int] = T.DOC_WORDS,
) -> DataFrame:
    """Only the rows that pass every gate: ``id, split, code, docstring, fp``.

    Where nobody asks for reasons the order of the gates is free, so the cheap one goes first: code
    is cleaned only for rows whose summary passes.
    """
    code, doc = F.col("code"), F.col("docstring")
    docs = _readable(pairs).filter(~F.col("malformed") & (code != "")).select(
        "id", "split", "code", T.clean_docstring(doc).alias("docstring")
    )
    summarised = _settled(docs.withColumn("doc_words", T.word_count(doc))).filter(
        _has_summary(doc) & F.col("doc_words").between(*doc_band)
    )
    cleaned = summarised.select("id", "split", T.clean_code(code).alias("code"), "docstring")
    counted = _settled(cleaned.withColumn("code_words", T.word_count(code)))
    fits = T.min_chars(code) & F.col("code_words").between(*code_band)
    return _settled(counted.filter(fits).select("id", "split", "code", "docstring", T.fingerprint(code).alias("fp")))


def passed(judged: DataFrame) -> DataFrame:
    """The gated rows among judged ones."""
    return judged.filter(F.col("reason").isNull()).drop("reason")


def train_registry(gated: DataFrame) -> DataFrame:
    """One row per training fingerprint with the first id that has it.

    Combined before the shuffle, so a fingerprint shared by most rows costs one row per task.
    """
    train = gated.filter(F.col("split") == TRAIN)
    return train.groupBy("fp").agg(F.min("id").alias("first_id"))


def _is_dupe() -> Column:
    """On rows left-joined with the registry: a later training copy, or a leaked eval row."""
    hit = F.col("first_id").isNotNull()
    return F.when(F.col("split") == TRAIN, F.col("id") != F.col("first_id")).otherwise(hit)


def refine(pairs: DataFrame, **bands: tuple[int, int]) -> DataFrame:
    """Refined rows of all splits: ``id, split, code, docstring``."""
    return refine_gated(gate_pairs(pairs, **bands))


def refine_gated(gated: DataFrame) -> DataFrame:
    """The deduplicating half of :func:`refine`, in one join of the text with the registry.

    The registry is dealt out apart from the join, so adaptive execution splits hot fingerprints.
    """
    kept = gated.join(apart(train_registry(gated), "fp"), "fp", "left").filter(~_is_dupe())
    return kept.select("id", "split", "code", "docstring")


def kept_ids(narrow: DataFrame) -> DataFrame:
    """Ids of the rows to keep, from gated rows without their text: ``id, split, fp``."""
    return narrow.join(apart(train_registry(narrow), "fp"), "fp", "left").filter(~_is_dupe()).select("id")


def reject_reason(judged: DataFrame) -> DataFrame:
    """Verdict for every row of ``id, split, reason, fp``: the failed gate, ``removed_dupe`` or ``kept``.

    The rows are read twice, so they should be stored. Rows that failed a gate have no fingerprint. They
    join on their own id, which matches nothing and spreads them evenly instead of piling them up under
    a null key.
    """
    rows = judged.select("id", "split", "reason", F.coalesce("fp", F.col("id").cast("string")).alias("fp"))
    verdict = F.coalesce("reason", F.when(_is_dupe(), "removed_dupe"), F.lit("kept"))
    joined = rows.join(apart(train_registry(passed(judged)), "fp"), "fp", "left")
    return joined.select("id", "split", verdict.alias("reason"))


def dedup_keep_first(rows: DataFrame, key: str = "fp", order: str = "id") -> DataFrame:
    """First row per key. The rank filter also runs before the shuffle, so hot keys stay cheap."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(order))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def cross_split_anti(gated: DataFrame) -> DataFrame:
    """Gated rows outside the training split whose fingerprint no gated training row has."""
    held_out = gated.filter(F.col("split") != TRAIN)
    return held_out.join(apart(train_registry(gated).select("fp"), "fp"), "fp", "left_anti")


def leakage_pairs(gated: DataFrame) -> DataFrame:
    """The rows :func:`cross_split_anti` removes, each with the training row that it met."""
    held_out = gated.filter(F.col("split") != TRAIN).select("id", "split", "fp")
    hits = held_out.join(apart(train_registry(gated), "fp"), "fp")
    return hits.select("id", "split", "fp", F.col("first_id").alias("train_id"))


def refinery_audit(judged: DataFrame) -> DataFrame:
    """Row counts per split and verdict, in one pass and without touching text after the gates.

    Equal rows are counted before the first shuffle; after it there is one row per split and
    fingerprint, so the window that looks for the training split sees a handful of rows per key.
    """
    counts = judged.groupBy("split", "reason", "fp").agg(F.count("*").alias("n"))
    in_train = F.max(F.when(F.col("reason").isNull() & (F.col("split") == TRAIN), 1)).over(
        W.partitionBy("fp")
    )
    kept = (
        F.when(F.col("reason").isNotNull(), 0)
        .when(F.col("split") == TRAIN, 1)
        .when(in_train.isNull(), F.col("n"))
        .otherwise(0)
    )
    n, reason = F.col("n"), F.col("reason")

    def bucket(name: str) -> Column:
        return F.coalesce(F.sum(F.when(reason == name, n)), F.lit(0)).alias(name)

    return (
        counts.withColumn("kept", kept.cast("bigint"))
        .groupBy("split")
        .agg(
            F.sum("n").alias("total"),
            F.sum("kept").alias("kept"),
            bucket("removed_len"),
            F.sum(F.when(reason.isNull(), n - F.col("kept")).otherwise(0)).alias("removed_dupe"),
            bucket("removed_doc"),
            bucket("malformed"),
            bucket("no_code"),
        )
    )
