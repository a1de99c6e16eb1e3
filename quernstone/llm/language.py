"""Language identification by Bayesian fusion of text, declared language, address suffix and host."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import frugal, give_back, lean_batches, mix64, stored

BINS = 1 << 14
PER_LANGUAGE = 400
MAX_LANGUAGES = 1024
SATURATION = 100.0
SMOOTHING = 5.0
ACCEPT = 0.5
UNKNOWN = "und"
UNKNOWN_SHARE = 0.01
STEP_BYTES = 1 << 18
# Bytes that belong to words: ASCII letters in lower case and everything beyond ASCII; all others are one gap.
_FOLD = np.zeros(256, dtype=np.uint8)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Columns:
    """Names of the input columns; without a name that evidence is missing."""

    id: str = "doc_id"
    text: str = "text"
    declared: str | None = "lang"
    host: str | None = "source"


@dataclass(frozen=True)
class Model:
    """Languages, and the log-probability of each trigram bin in each of them; the last is unknown text."""

    languages: tuple[str, ...]
    table: np.ndarray


def _bins(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each byte trigram, and whether it starts or ends inside a word."""
    x = _FOLD[data].astype(np.uint32)
    if len(x) < 3:
        return np.empty(0, np.int64), np.empty(0, bool)
    code = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
    mixed = code * np.uint32(2654435761)
    return ((mixed ^ (mixed >> np.uint32(15))) & np.uint32(BINS - 1)).astype(np.int64), (x[1:-1] != 0)


def _whole(text: str | None) -> bytes:
    return b" " + (text or "").encode("utf-8", "replace") + b" "


def text_scores(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Summed log-likelihood per language, and the number of trigrams, of whole texts, a step at a time."""
    sums, counts = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), dtype=np.int64)
    held, owner, size = [], [], 0

    def flush() -> None:
        if not held:
            return
        data = np.frombuffer(b"".join(held), dtype=np.uint8)
        sizes = np.array([len(h) for h in held])
        first = np.cumsum(sizes) - sizes
        bins, inside = _bins(data)
        seams = np.cumsum(sizes)[:-1]
        inside[seams - 1] = inside[seams - 2] = False
        scores = np.where(inside[:, None], model.table[bins], 0)
        np.add.at(sums, owner, np.add.reduceat(scores, first, axis=0, dtype=np.float64))
        np.add.at(counts, owner, np.add.reduceat(inside.astype(np.int64), first))

    for row, text in enumerate(texts):
        raw = _whole(text)
        for at in range(0, len(raw) - 2, STEP_BYTES):
            held.append(raw[at : at + STEP_BYTES + 2])
            owner.append(row)
            size += len(held[-1])
            if size >= STEP_BYTES:
                flush()
                held, owner, size = [], [], 0
    flush()
    return sums, counts


def _count_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for language, text in zip(batch.column("language").to_pylist(), batch.column("text").to_pylist()):
            bins, inside = _bins(np.frombuffer(_whole(text), dtype=np.uint8))
            own, n = np.unique(bins[inside], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(own), pa.string()), pa.array(own, pa.int64()), pa.array(n, pa.int64())], names=["language", "bin", "n"])


def declared_of(columns: Columns) -> Column:
    """The declared language without its region, in lower case; null where it is missing or empty."""
    return F.nullif(F.lower(F.substring_index(F.col(columns.declared).cast("string"), "-", 1)), F.lit(""))


def fit(docs: DataFrame, columns: Columns, per_language: int = PER_LANGUAGE, max_languages: int = MAX_LANGUAGES) -> Model:
    """Trigram model of the declared languages, from at most ``per_language`` documents of each.

    Labels are taken up to a hyphen, in lower case, so ``en-US`` is ``en``. The ``max_languages`` commonest
    are learned: the sample has no documents of further ones, which :func:`identify` leaves undecided.
    Documents are those with the smallest hashes of the id; ids and hashes move, texts do not. Sizes of
    sample and model are bounded by the parameters.
    """
    if columns.declared is None:
        raise ValueError("a model needs declared languages to learn from, or must be given")
    named = docs.select(F.col(columns.id).alias("id"), declared_of(columns).alias("language")).filter("id IS NOT NULL AND language IS NOT NULL")
    common = named.groupBy("language").count().orderBy(F.desc("count"), "language").limit(max_languages)
    languages = tuple(sorted(r["language"] for r in common.collect()))
    marked = named.withColumn("h", F.xxhash64(F.lit("language"), "id")).filter(F.col("language").isin(*languages))
    least = marked.groupBy("language", F.pmod(F.xxhash64("h"), F.lit(per_language)).alias("cell")).agg(F.min_by("id", "h").alias("id"))
    chosen = F.broadcast(stored(least.select("id", "language"), "sample"))
    rows = docs.select(F.col(columns.id).alias("id"), F.col(columns.text).alias("text"), declared_of(columns).alias("language")).join(chosen, ["id", "language"])
    counts = rows.select("language", "text").mapInArrow(frugal(_count_bins), "language string, bin long, n long").groupBy("language", "bin").agg(F.sum("n").alias("n"))
    table = np.full((BINS, len(languages) + 1), 0.5)
    at = {language: k for k, language in enumerate(languages)}
    for language, bin_, n in counts.collect():
        table[bin_, at[language]] += n
    table[:, -1] = 1.0
    return Model((*languages, UNKNOWN), np.log(table / table.sum(axis=0)).astype(np.float32))


def _scorer(model: Model):
    @F.pandas_udf("struct<score:array<double>,n:long>")
    def score(texts: pd.Series) -> pd.DataFrame:
        sums, counts = text_scores(texts.to_list(), model)
        weight = 1 / (1 + counts / SATURATION)
        give_back()
        return pd.DataFrame({"score": list(sums * weight[:, None]), "n": counts})

    return score


def _evidence(docs: DataFrame, model: Model, columns: Columns) -> DataFrame:
    """``_row`` and the clues of each document."""
    null = F.lit(None).cast("string")
    declared = declared_of(columns) if columns.declared else null
    host = F.lower(F.col(columns.host).cast("string")) if columns.host else null
    suffix, domain = F.regexp_extract(host, r"\.([a-z]+)$", 1), F.regexp_extract(host, r"([^.]+\.[a-z]+)$", 1)
    return docs.select(
        F.struct("*").alias("_row"), _scorer(model)(F.col(columns.text)).alias("_text"), declared.alias("_declared"), host.alias("_host"),
        F.when(suffix != "", suffix).alias("_suffix"), F.when(domain != "", domain).otherwise("").alias("_domain"),
    )


def _counted(rows: DataFrame, by: list[str], languages: int, name: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.array(*[F.sum((F.col("best") == k).cast("double")) for k in range(languages)]).alias(name))


def _smoothed(own: Column, parent: Column) -> Column:
    """Shares of ``own`` counts, drawn towards ``parent`` shares by ``SMOOTHING`` documents."""
    total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(own, parent, lambda n, p: (n + SMOOTHING * p) / (total + SMOOTHING))


def _beliefs(docs: DataFrame, model: Model, columns: Columns) -> tuple[DataFrame, DataFrame, DataFrame, list[float]]:
    """Log-prior per host, log-likelihood per declared language and per suffix, and the overall log-prior."""
    size = len(model.languages)
    clues = stored(
        _evidence(docs, model, columns).filter("_text.n > 0")
        .select("_declared", "_suffix", "_host", "_domain", F.expr("array_position(_text.score, array_max(_text.score)) - 1").alias("best")),
        "clues",
    )
    total = np.array((clues.agg(*[F.sum((F.col("best") == k).cast("double")) for k in range(size)]).first() or [0.0] * size), dtype=object)
    total = np.array([x or 0.0 for x in total])
    prior = np.append((total[:-1] + 1) / (total[:-1].sum() + size - 1) * (1 - UNKNOWN_SHARE), UNKNOWN_SHARE)
    overall = F.array(*[F.lit(float(p)) for p in prior])
    domains = stored(_counted(clues, ["_domain"], size, "d").select("_domain", F.when(F.col("_domain") == "", overall).otherwise(_smoothed(F.col("d"), overall)).alias("d")), "domains")
    hosts = _counted(clues.filter("_host IS NOT NULL"), ["_host", "_domain"], size, "h").join(domains, "_domain")
    logs = lambda c: F.transform(c, lambda x: F.log(x))
    by_host = stored(hosts.select("_host", logs(_smoothed(F.col("h"), F.col("d"))).alias("_prior")), "hosts")

    def said(column: str, out: str) -> DataFrame:
        """P(value | language), drawn towards the value's share of all documents."""
        of = F.array(*[F.lit(float(n)) for n in total])
        share = F.aggregate("c", F.lit(0.0), lambda a, x: a + x) / F.lit(float(max(total.sum(), 1.0)))
        return stored(
            _counted(clues.filter(F.col(column).isNotNull()), [column], size, "c")
            .select(column, logs(F.zip_with("c", of, lambda c, n: (c + SMOOTHING * share) / (n + SMOOTHING))).alias(out)),
            out,
        )

    return by_host, said("_declared", "_says"), said("_suffix", "_ends"), [float(np.log(p)) for p in prior]


def identify(
    docs: DataFrame, columns: Columns = Columns(), model: Model | None = None, accept: float = ACCEPT
) -> DataFrame:
    """``_row`` (the document as a struct), ``language, confidence, accepted`` for every row of ``docs``.

    The posterior of a language is the product of four parts: the likelihood of all byte trigrams of the
    text, whose weight saturates so that long texts do not drown the rest; the likelihood of the declared
    language and of the address suffix, each counted over all documents against what their text says;
    and the prior of the host, whose counts are drawn towards those of its domain, and those towards all
    documents. Text in no known language competes as ``und``. A document is accepted when its best
    language is not ``und`` and reaches ``accept``.

    Counts come from one pass over the whole table, decisions from a second, so texts are never
    shuffled; the tables of hosts, declared languages and suffixes are joined by what Spark finds best
    for their size. ``model`` is fitted on a bounded sample of ``docs`` if none is given.

    Texts whose declared language the model has not learned are left undecided: they keep that language,
    with confidence 0, and are accepted.

    Null texts and such without letters have no language: ``und``, not accepted. Missing clues (null, or
    never seen) say nothing. Repeated rows are judged alike. An empty table gives no rows.
    """
    lean_batches(docs.sparkSession)
    model = model or fit(docs, columns)
    by_host, says, ends, prior = _beliefs(docs, model, columns)
    flat = F.array(*[F.lit(0.0)] * len(model.languages))
    joined = (
        _evidence(docs, model, columns)
        .join(by_host, "_host", "left").join(says, "_declared", "left").join(ends, "_suffix", "left")
    )
    parts = [F.col("_text.score"), F.coalesce("_prior", F.array(*[F.lit(p) for p in prior])), F.coalesce("_says", flat), F.coalesce("_ends", flat)]
    total = parts[0]
    for part in parts[1:]:
        total = F.zip_with(total, part, lambda a, b: a + b)
    names = F.array(*[F.lit(name) for name in model.languages])
    judged = joined.withColumn("_total", total).withColumn("_top", F.array_max("_total"))
    confidence = 1 / F.aggregate("_total", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_top")))
    best = F.element_at(names, F.array_position("_total", F.col("_top")).cast("int"))
    lettered = F.col("_text.n") > 0
    foreign = lettered & F.coalesce(~F.col("_declared").isin(*model.languages), F.lit(False))
    language = F.when(foreign, F.col("_declared")).when(lettered, best).otherwise(UNKNOWN)
    found = judged.select("_row", foreign.alias("_foreign"), language.alias("language"), F.when(lettered & ~foreign, confidence).otherwise(0.0).alias("confidence"))
    accepted = F.col("_foreign") | ((F.col("language") != UNKNOWN) & (F.col("confidence") >= accept))
    return found.select("_row", "language", "confidence", accepted.alias("accepted"))
