"""URL filter: rules first, then logistic regression on hashed character n-grams. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GRAM = 3
BUCKETS = 2048
SAMPLE = 4000
TURNS = 25
RATE = 0.5

Rule = tuple[str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule ``host/path`` that fits the host or a parent domain of it, and its verdict; else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in sorted(rules, key=lambda r: len(r[1])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def gram_buckets(host: Column, path: Column, gram: int = GRAM, buckets: int = BUCKETS) -> Column:
    """Distinct hash buckets of all runs of ``gram`` characters of ``^host|path$``."""
    letters = F.split(F.concat(F.lit("^"), host, F.lit("|"), path, F.lit("$")), "")
    runs = F.transform(F.sequence(F.lit(1), F.size(letters) - gram + 1), lambda i: F.array_join(F.slice(letters, i, gram), ""))
    return F.array_distinct(F.transform(runs, lambda g: F.pmod(F.xxhash64(g), F.lit(buckets)).cast("int")))


def _margin(features: Column, weights: Sequence[float], bias: float) -> Column:
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    return F.aggregate(features, F.lit(0.0), lambda total, f: total + F.get(table, f)) / F.sqrt(F.size(features)) + F.lit(bias)


def train(labelled: DataFrame, buckets: int = BUCKETS, turns: int = TURNS, rate: float = RATE) -> tuple[list[float], float]:
    """Weights and bias from ``features array<int>, block boolean``.

    Full gradients with a step per weight; both labels weigh the same. A turn is one grouped sum, and at
    most ``buckets`` sums come to the driver. Without rows of both labels everything is allowed.
    """
    sizes = dict(labelled.groupBy("block").count().collect())
    if len([n for k, n in sizes.items() if k is not None and n]) < 2:
        return [0.0] * buckets, -1.0
    share = F.when(F.col("block"), 0.5 / sizes[True]).otherwise(0.5 / sizes[False])
    weights, bias = [0.0] * buckets, 0.0
    past, past_bias = [0.0] * buckets, 0.0
    for _ in range(turns):
        wrong = (1 / (1 + F.exp(-_margin(F.col("features"), weights, bias))) - F.col("block").cast("double")) * share
        one = labelled.select("features", wrong.alias("wrong"))
        scaled = one.select(F.explode(F.concat("features", F.array(F.lit(-1)))).alias("f"), F.size("features").alias("n"), "wrong")
        sums = scaled.groupBy("f").agg(F.sum(F.when(F.col("f") < 0, F.col("wrong")).otherwise(F.col("wrong") / F.sqrt("n"))))
        for f, g in sums.collect():
            if f < 0:
                past_bias += g * g
                bias -= rate * g / math.sqrt(past_bias + 1e-12)
            else:
                past[f] += g * g
                weights[f] -= rate * g / math.sqrt(past[f] + 1e-12)
    return [round(w, 6) for w in weights], round(bias, 6)


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
    gram: int = GRAM, buckets: int = BUCKETS, sample: int = SAMPLE, turns: int = TURNS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    The longest rule that fits decides. For all other urls a logistic regression on the hashed character
    n-grams of host and path says ``block`` or ``allow``. It learns from ``labelled`` (``url, block``), or,
    where none is given, from the different hosts and paths that rules decide; in either case from at
    most ``sample`` of them, those with the smallest hashes.

    Null urls, and such without ``://``, have empty host and path and are judged like any other. Repeated
    rows are judged alike, an empty table gives no rows, other columns are ignored.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumn("rule", rule).withColumn("said", verdict)
    if labelled is None:
        known = ruled.filter("rule IS NOT NULL").select("host", "path", (F.col("said") == "block").alias("block"))
    else:
        known = labelled.filter("block IS NOT NULL").select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "block")
    seen = known.distinct().orderBy(F.xxhash64("host", "path"), "host", "path", "block").limit(sample)
    features = gram_buckets(F.col("host"), F.col("path"), gram, buckets)
    weights, bias = train(stored(seen.select(features.alias("features"), "block"), "labelled-urls"), buckets, turns)
    learned = F.when(_margin(features, weights, bias) >= 0, "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", "rule", F.coalesce("said", learned).alias("verdict"))
