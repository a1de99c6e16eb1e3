"""Mix sources to target weights: certain whole copies, then Pareto order sampling of fixed size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quernstone.llm.common import apart, stored
from quernstone.operators.positions import positions_in_order

# Fixed value: what counts as a word.
WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 65_536
TURNS = 3
SEED = 271


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """Sorts by code point with null last, and joins null to null."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def _uniform(doc_id: Column, seed: int) -> Column:
    """48 hashed bits of the id as a number strictly between 0 and 1."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def described(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """What a decision needs of each document, beside whatever ``docs`` holds in ``_row``."""
    narrow = docs.select(
        F.struct("*").alias("_row"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("_id"),
        word_count(F.col(text_col)).alias("_size"), _source_key(F.col(source_col)).alias("_source"),
        _uniform(F.col(id_col), seed).alias("_u"),
    )
    return narrow.withColumn("_level", F.when(F.col("_size") > 0, F.length(F.bin("_size"))).otherwise(0))


def source_targets(totals: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """``_source, s, target``: the budget by weight, no target above ``cap`` times its source's size.

    What a full source cannot take is shared among the others by weight again, until nothing changes.
    Each turn is one aggregate over the sources.
    """
    ranked, _ = positions_in_order(totals, ["_source"], "rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = ranked.select("_source", "s", F.element_at(cycle, (F.col("rank") - 1).cast("int") % len(weights) + 1).alias("w"))
    full = (F.col("s") * cap).cast("double")
    rate = -1.0
    while True:
        done = F.col("w") * rate >= full
        whole, fixed, free = weighed.agg(
            F.sum("s"), F.sum(F.when(done, full).otherwise(0.0)), F.sum(F.when(~done, F.col("w")))
        ).first()
        budget = share * (whole or 0)
        if not free:
            break
        before, rate = rate, (budget - fixed) / free
        if rate == before:
            break
    return weighed.select("_source", "s", F.least(full, F.col("w") * F.lit(rate) if rate >= 0 else full).alias("target"))


def _copies(levels: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """Expected copies of each (source, size level): ``min(cap, c * (1 + level))`` with a ``c`` per source.

    Longer documents, by the binary digits of their word count, have better odds. A source has at most 64 levels.
    """
    odds = F.col("_level") + 1
    joined = levels.join(targets, "_source")
    down = W.partitionBy("_source").orderBy(F.desc("_level"))
    above = F.coalesce(F.sum("words").over(down.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    below = F.sum(odds * F.col("words")).over(down.rowsBetween(0, W.unboundedFollowing))
    tried = joined.withColumn("c", F.when(F.col("words") > 0, (F.col("target") - cap * above) / below))
    fits = F.when(F.col("c") * odds <= cap, F.struct("_level", "c"))
    best = tried.withColumn("c", F.max(fits).over(W.partitionBy("_source"))["c"])
    copies = F.when(F.col("_level") == 0, 0.0).otherwise(F.least(F.lit(float(cap)), F.coalesce(F.col("c") * odds, F.lit(float(cap)))))
    split = best.withColumn("copies", copies).withColumn("whole", F.floor("copies")).withColumn("part", F.col("copies") - F.col("whole"))
    need = F.col("target") - F.sum(F.col("whole") * F.col("words")).over(W.partitionBy("_source"))
    return split.select("_source", "_level", F.col("s"), "target", "whole", "part", need.alias("need"))


def mixing_rules(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[float], share: float, cap: float, seed: int
) -> DataFrame:
    """What decides about every document: one row per source and size level."""
    narrow = stored(described(docs, id_col, text_col, source_col, seed).drop("_row"), "sizes")
    levels = stored(narrow.groupBy("_source", "_level").agg(F.sum("_size").alias("words")), "levels")
    totals = levels.groupBy("_source").agg(F.sum("words").alias("s"))
    plan = stored(_copies(levels, source_targets(totals, weights, share, cap), cap), "copies")
    ranked = _ranked(narrow.join(plan, ["_source", "_level"])).filter("part > 0")
    left = stored(ranked.select("_source", "bucket", "place", "_size", F.col("need").alias("gap")), "ranked")
    rules = plan.drop("need")
    for turn in range(TURNS):
        cut = stored(_fitting(left), f"cut-{turn}")
        rules = rules.join(cut.select("_source", F.col("upto").alias(f"upto{turn}"), F.col("limit").alias(f"limit{turn}")), "_source", "left")
        passed = left.drop("gap").join(cut, "_source").filter("upto IS NULL OR place > upto OR _size > limit")
        left = passed.select("_source", "bucket", "place", "_size", "gap").filter("_size <= gap" if turn < TURNS - 1 else "_size < 2 * gap")
    extra = left.groupBy("_source").agg(F.min(F.struct(F.abs(F.col("gap") - F.col("_size")).alias("off"), "place"))["place"].alias("extra"))
    return stored(rules.join(extra, "_source", "left"), "rules")


def _fitting(rows: DataFrame) -> DataFrame:
    """Per source, how far its rows in order of ``place`` fit into ``gap`` words, and what is left then.

    Words are summed over ranges of the ratio first; a running sum over rows is needed in one range only.
    """
    before = W.partitionBy("_source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    edge = (
        rows.groupBy("_source", "bucket").agg(F.sum("_size").alias("words"), F.first("gap").alias("limit"))
        .withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .filter("before <= limit")
        .groupBy("_source").agg(F.max(F.struct("bucket", "before")).alias("edge"), F.first("limit").alias("limit"))
        .select("_source", "limit", F.col("edge.bucket").alias("edge"), F.col("edge.before").alias("before"))
    )
    known = apart(edge, "_source")
    near = rows.join(known, "_source")
    running = F.sum("_size").over(W.partitionBy("_source").orderBy("place").rowsBetween(W.unboundedPreceding, 0))
    inside = near.filter("bucket = edge").withColumn("words", F.col("before") + running).filter("words <= limit")
    last = inside.groupBy("_source").agg(F.max("place").alias("at"), F.max("words").alias("got"))
    lower = near.filter("bucket < edge").groupBy("_source").agg(F.max("place").alias("lower"))
    return known.join(last, "_source", "left").join(lower, "_source", "left").select(
        "_source", F.coalesce("at", "lower").alias("upto"), "limit", (F.col("limit") - F.coalesce("got", "before")).alias("gap")
    )


def _drawn() -> Column:
    """Whether a document is among those that a turn has taken, or the one added at the end."""
    taken = F.col("place") == F.col("extra")
    for turn in range(TURNS):
        fits = (F.col("place") <= F.col(f"upto{turn}")) & (F.col("_size") <= F.col(f"limit{turn}"))
        taken = F.coalesce(taken, F.lit(False)) | F.coalesce(fits, F.lit(False))
    return taken & (F.col("part") > 0)


def _ranked(joined: DataFrame) -> DataFrame:
    """Random odds over inclusion odds, and a bucket whose order agrees with them."""
    ratio = F.col("_u") / (1 - F.col("_u")) * ((1 - F.col("part")) / F.col("part"))
    return joined.withColumn("ratio", F.when(F.col("part") > 0, ratio)).withColumn(
        "bucket", F.floor(F.col("ratio") / (1 + F.col("ratio")) * BUCKETS)
    ).withColumn("place", F.struct("ratio", "_id", "_size"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = SEED,
) -> DataFrame:
    """``_row`` (the document as a struct), ``size, source_size, target, copies, taken`` for every row of ``docs``.

    Sources in code point order (null last, a source of its own) have the ``weights`` in turn and share
    ``share`` times all words; no target exceeds ``cap`` times its source. In a source a document of
    level ``l`` (binary digits of its word count) expects ``min(cap, c * (1 + l))`` copies, with ``c``
    such that the words meet the target. The whole part is certain. For the fraction, documents are
    ranked by random odds over inclusion odds and taken in that order until the words that are missing
    are reached. Where a long one would exceed them it is passed over and shorter ones further down fill
    the rest, in ``TURNS`` turns altogether; one more, the closest in size to what is left then, is added
    if that brings the source nearer.
    Running sums are built over 65,536 ranges of the ratio and inside one of them, so no source, however
    large, meets in one task. Decisions rest on one small table of rules, to which documents are joined.

    Null or blank texts have no words and are never taken. Rows that repeat an id draw the same number.
    Random numbers come from the id and ``seed``, so reruns agree. Empty tables give no rows.
    """
    rules = mixing_rules(docs, id_col, text_col, source_col, weights, share, cap, seed)
    joined = _ranked(described(docs, id_col, text_col, source_col, seed).join(rules, ["_source", "_level"]))
    copies = (F.col("whole") + _drawn().cast("long")).cast("long")
    return joined.select(
        "_row", F.col("_size").alias("size"), F.col("s").cast("long").alias("source_size"), "target", copies.alias("copies"),
        (copies * F.col("_size")).alias("taken"),
    )
