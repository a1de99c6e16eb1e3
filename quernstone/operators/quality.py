"""Scores of predicted texts: corpus BLEU, ROUGE-L, cross-entropy, perplexity.

Pair frames carry a row ``id``, group columns such as ``run``, and word arrays ``ref`` and ``hyp``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType, StructField, StructType

from quernstone.functions import runs as R
from quernstone.functions import text as T
from quernstone.functions.stem import stem

MAX_ORDER = 4
EPSILON = 0.1


# --- BLEU ------------------------------------------------------------------------------------


BLEU_SUMS = ["hyp_len", "ref_len", *[f"slots{n}" for n in range(1, MAX_ORDER + 1)], *[f"match{n}" for n in range(1, MAX_ORDER + 1)]]


def _row_sums(ref: Sequence[str], hyp: Sequence[str]) -> list[int]:
    """Lengths, n-gram slots of the hypothesis, and its matches clipped to their counts in the reference."""
    slots, matches = [], []
    for n in range(1, MAX_ORDER + 1):
        grams = [Counter(zip(*(words[k:] for k in range(n)))) for words in (hyp, ref)]
        slots.append(max(1, len(hyp) - n + 1))
        matches.append((grams[0] & grams[1]).total())
    return [len(hyp), len(ref), *slots, *matches]


@pandas_udf(StructType([StructField(name, LongType()) for name in BLEU_SUMS]))
def _bleu_sums(ref: pd.Series, hyp: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_row_sums(list(r), list(h)) for r, h in zip(ref, hyp)], columns=BLEU_SUMS, dtype="int64")


def corpus_bleu(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Corpus BLEU-4 with one reference and 0.1 in place of missing matches, per group.

    Clipped counts are a matter of one row, so they are taken in the row; what travels is one row of
    sums per group and task.
    """
    counted = pairs.select(*by, _bleu_sums("ref", "hyp").alias("s")).select(*by, "s.*")
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in BLEU_SUMS]
    return counted.groupBy(*by).agg(*sums).select(*by, _bleu().alias("bleu"), "hyp_len", "ref_len")


def _bleu() -> Column:
    logs = [
        F.ln(F.greatest(F.col(f"match{n}"), F.lit(EPSILON)) / F.greatest(F.col(f"slots{n}"), F.lit(1)))
        for n in range(1, MAX_ORDER + 1)
    ]
    shortness = F.when(F.col("hyp_len") > F.col("ref_len"), 1.0).otherwise(
        F.exp(1 - F.try_divide(F.col("ref_len"), F.col("hyp_len")))
    )
    score = shortness * F.exp(sum(logs[1:], logs[0]) / MAX_ORDER)
    return F.when((F.col("match1") == 0) | (F.col("hyp_len") == 0), 0.0).otherwise(score)


# --- ROUGE-L ---------------------------------------------------------------------------------


def rouge_tokens(text: Column) -> Column:
    """Lower-case runs of a-z and 0-9."""
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " "), "")


def _common_length(ref: Sequence[str], hyp: Sequence[str]) -> int:
    """Length of the longest common subsequence; one machine-word-parallel step per hypothesis word."""
    places: dict[str, int] = {}
    for i, word in enumerate(ref):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(ref)) - 1
    free = full
    for word in hyp:
        hit = free & places.get(word, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(ref) - free.bit_count()


def _overlap(stemmed: bool) -> Callable:
    @pandas_udf("int")
    def common(ref: pd.Series, hyp: pd.Series) -> pd.Series:
        def words(tokens: Sequence[str]) -> Sequence[str]:
            return [stem(t) if len(t) > 3 else t for t in tokens] if stemmed else tokens

        return pd.Series([_common_length(words(r), words(h)) for r, h in zip(ref, hyp)], dtype="int32")

    return common


def rouge_l(pairs: DataFrame, stemmed: bool = True) -> DataFrame:
    """Add the ROUGE-L F-measure of each row; 0 where nothing is shared."""
    tokens = {f"_{s}": rouge_tokens(F.array_join(s, " ")) for s in ("ref", "hyp")}
    common = _overlap(stemmed)(F.col("_ref"), F.col("_hyp"))
    f_measure = 2 * F.col("_lcs") / (F.size("_ref") + F.size("_hyp"))
    return (
        pairs.withColumns(tokens)
        .withColumn("_lcs", common)
        .withColumn("rougeL", F.when(F.col("_lcs") > 0, f_measure).otherwise(0.0))
        .drop("_ref", "_hyp", "_lcs")
    )


def rouge_l_mean(pairs: DataFrame, by: Sequence[str] = (), stemmed: bool = True) -> DataFrame:
    scored = rouge_l(pairs, stemmed).groupBy(*by)
    return scored.agg(F.coalesce(F.avg("rougeL"), F.lit(0.0)).alias("rougeL"))


# --- loss ------------------------------------------------------------------------------------


def loss_perplexity(tokens: DataFrame, by: Sequence[str] = (), nll: str = "nll", weight: str | None = None) -> DataFrame:
    """Token-weighted mean loss and its perplexity; no tokens give a loss of 0.

    ``weight`` names a column with the number of equal tokens a row stands for.
    """
    n = F.col(weight) if weight else F.lit(1)
    sums = tokens.groupBy(*by).agg(
        F.sum(F.col(nll) * n).alias("_loss"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("n_tokens")
    )
    loss = F.coalesce(F.try_divide("_loss", "n_tokens"), F.lit(0.0))
    return sums.select(*by, loss.alias("loss"), "n_tokens").withColumn("perplexity", R.perplexity(F.col("loss")))


def unigram_losses(rows: DataFrame, train: DataFrame, words: str, by: Sequence[str] = ()) -> DataFrame:
    """Add-one unigram loss of every word as ``nll`` with its number of occurrences ``n``.

    Both sides are counted per word before they meet, so a word that fills a third of all text is
    one row per group on the left and one on the right.
    """
    def counted(df: DataFrame, *keys: str) -> DataFrame:
        return df.select(*keys, F.explode(words).alias("word")).groupBy(*keys, "word").agg(F.count("*").alias("n"))

    model = counted(train).withColumnRenamed("n", "_seen")
    size = model.agg(F.sum("_seen").alias("t"), F.count("*").alias("v")).select((F.col("t") + F.col("v") + 1).alias("s"))
    share = (F.coalesce("_seen", F.lit(0)) + 1) / F.col("_size")
    return (
        counted(rows, *by).join(model, "word", "left")
        .withColumn("_size", size.scalar())
        .select(*by, "word", "n", (-F.ln(share)).alias("nll"))
    )


def mean_of_batch_means(tokens: DataFrame, by: Sequence[str] = (), batch: str = "batch_id") -> DataFrame:
    """Unweighted mean of per-batch mean losses; padding (id 0) does not count."""
    real = tokens.filter(F.col("token_id") != 0)
    means = real.groupBy(*by, batch).agg(F.avg("nll").alias("_mean"))
    return means.groupBy(*by).agg(F.coalesce(F.avg("_mean"), F.lit(0.0)).alias("loss"))


# --- predictions -----------------------------------------------------------------------------

Scorer = Callable[[pd.DataFrame], pd.DataFrame]


OUTPUTS = ["prediction", "nll_sum", "n_tokens"]
OUTPUT_SCHEMA = "prediction string, nll_sum double, n_tokens bigint, error string"


def _attempt(score: Scorer, batch: pd.DataFrame, names: list[str]) -> Iterator[pd.DataFrame]:
    """``batch`` scored; if that fails, tried again row by row, so only the failing rows get an error."""

    def scored(rows: pd.DataFrame) -> pd.DataFrame:
        out = score(rows)[OUTPUTS].reset_index(drop=True)
        return pd.concat([rows[names].reset_index(drop=True), out], axis=1).assign(error=None)

    try:
        yield scored(batch)
        return
    except Exception:  # a scorer may fail in any way; narrowed down to rows below
        pass
    for at in range(len(batch)):
        row = batch.iloc[at:at + 1]
        try:
            yield scored(row)
        except Exception as problem:
            yield row[names].reset_index(drop=True).assign(prediction=None, nll_sum=None, n_tokens=None, error=str(problem))


def batch_predict(rows: DataFrame, make_scorer: Callable[[], Scorer], keep: Sequence[str] = ("id", "run")) -> DataFrame:
    """Run a user's scorer over all rows: ``prediction, nll_sum, n_tokens`` or an ``error``.

    ``make_scorer`` is called once per task (to load a model, say). The scorer gets batches with
    ``code`` and ``docstring`` and returns those three columns, row by row.
    """
    kept = [f for f in rows.schema.fields if f.name in keep]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    names = [f.name for f in kept]

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = make_scorer()
        for batch in batches:
            yield from _attempt(score, batch, names)

    return rows.select(*dict.fromkeys([*names, "code", "docstring"])).mapInPandas(task, f"{schema}, {OUTPUT_SCHEMA}")


def predict_runs(
    rows: DataFrame, scorers: Mapping[str, Callable[[], Scorer]], keep: Sequence[str] = ("id", "docstring"), done: str | None = None
) -> DataFrame:
    """Every run's scorer over the same rows in one pass: a row per run and input row, with the run's ``file``.

    Rows are read and sent to Python once, however many runs there are. ``done`` names a column of run
    files that a row needs no more; a scorer is made when the first row of a task asks for it.
    """
    kept = [f for f in rows.schema.fields if f.name in keep]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    names = [f.name for f in kept]

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: dict[str, Scorer] = {}
        for batch in batches:
            had = [set() if d is None else set(d) for d in batch[done]] if done else None
            for file, make in scorers.items():
                wanted = batch if had is None else batch[[file not in h for h in had]]
                if len(wanted):
                    score = made.get(file) or made.setdefault(file, make())
                    for out in _attempt(score, wanted, names):
                        yield out.assign(file=file)

    columns = dict.fromkeys([*names, "code", "docstring", *([done] if done else [])])
    return rows.select(*columns).mapInPandas(task, f"{schema}, {OUTPUT_SCHEMA}, file string")


def keyword_scorer(k: int = 12) -> Callable[[], Scorer]:
    """A baseline that predicts the ``k`` commonest words of the code, ties alphabetically.

    Its stated loss is a tenth of a nat per character of the docstring's words.
    """
    def make() -> Scorer:
        def summary(code: str) -> str:
            counts = Counter(code.split())
            return " ".join(sorted(counts, key=lambda w: (-counts[w], w))[:k])

        def score(batch: pd.DataFrame) -> pd.DataFrame:
            words = batch["docstring"].str.split()
            return pd.DataFrame({
                "prediction": [summary(c) for c in batch["code"]],
                "nll_sum": [sum(map(len, w)) / 10 for w in words],
                "n_tokens": words.str.len().astype("int64"),
            })

        return score

    return make


def evaluation_report(predictions: DataFrame, file: str = "file", stemmed: bool = True) -> DataFrame:
    """One row per run: ``file, model, bleu, rougeL, loss, perplexity``; failed rows do not count.

    ``predictions`` come from :func:`batch_predict` and keep the ``docstring`` they are compared with.
    """
    good = predictions.filter(F.col("error").isNull())
    pairs = good.select(
        file, "nll_sum", "n_tokens",
        T.split_words(F.col("docstring")).alias("ref"), T.split_words(F.col("prediction")).alias("hyp"),
    )
    bleu = corpus_bleu(pairs.select(file, "ref", "hyp"), [file]).select(file, "bleu")
    rest = rouge_l(pairs, stemmed).groupBy(file).agg(
        F.avg("rougeL").alias("rougeL"),
        F.coalesce(F.try_divide(F.sum("nll_sum"), F.sum("n_tokens")), F.lit(0.0)).alias("loss"),
    )
    return bleu.join(rest, file).select(
        file, R.model_tag(F.col(file)).alias("model"), "bleu", "rougeL", "loss",
        R.perplexity(F.col("loss")).alias("perplexity"),
    )
