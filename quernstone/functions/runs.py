"""Expressions over run names, run metrics and log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Model families, in the order in which a file name is tested for them.
MODEL_TAGS = ("transformer", "lstm_dotproduct", "lstm_bahdanau")
DEFAULT_MODEL = "lstm_bahdanau"

PERPLEXITY_CUTOFF = 100.0

# What counts as a number in a text; the engine's own cast also reads type letters at the end.
NUMBER = r"(?i)^\s*[-+]?(?:(?:\d+\.?\d*|\.\d+)(?:e[-+]?\d+)?|inf|infinity)\s*$"


def model_tag_strict(file: Column) -> Column:
    """Model family named in a run file; null for an unknown one."""
    name = F.lower(file)
    return F.coalesce(*[F.when(name.contains(tag), tag) for tag in MODEL_TAGS])


def model_tag(file: Column) -> Column:
    """Like :func:`model_tag_strict`, with unknown names taken for the default family."""
    return F.coalesce(model_tag_strict(file), F.lit(DEFAULT_MODEL))


def subset_size(file: Column) -> Column:
    digits = F.regexp_extract(file, r"(?i)sub(\d+)", 1)
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def run_short_name(path: Column) -> Column:
    """File name without directory, extension and leading timestamp."""
    base = F.regexp_replace(path, r"(?s)^.*/", "")
    stem = F.regexp_replace(base, r"(?<=[^.])\.[^.]*$", "")
    return F.regexp_replace(stem, r"^\d{8}_\d{6}_", "")


def score_tag(bleu: Column) -> Column:
    return F.when(bleu > 0.0001, F.format_string("B%.2f", bleu)).otherwise("NA")


def run_slug(started: Column, model: Column, subset: Column, bleu: Column) -> Column:
    """``TIMESTAMP_MODEL_SUBSET_SCORE`` archive name of a run."""
    size = F.when(subset.isNull() | (subset == 0), "ALL").otherwise(subset.cast("string"))
    return F.concat_ws(
        "_",
        F.date_format(started, "yyyyMMdd_HHmmss"),
        F.substring(F.upper(model), 1, 5),
        F.concat(F.lit("S"), size),
        score_tag(F.coalesce(bleu, F.lit(0.0))),
    )


def to_numeric_coerce(text: Column) -> Column:
    """Number in a text; anything unreadable (or NaN) counts as 0."""
    value = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(value.isNull() | F.isnan(value), 0.0).otherwise(value)


def throughput(subset: Column, mean_epoch: Column) -> Column:
    """Rows per second; null where the divisor is 0."""
    return F.try_divide(subset, mean_epoch)


def time_per_1k(subset: Column, mean_epoch: Column) -> Column:
    return F.try_divide(mean_epoch, subset) * 1000


def perplexity(loss: Column) -> Column:
    return F.when(loss < PERPLEXITY_CUTOFF, F.exp(loss)).otherwise(F.lit(float("inf")))


def render_epoch_line(
    epoch: Column, train_loss: Column, val_loss: Column, lr: Column, seconds: Column
) -> Column:
    return F.format_string(
        "Epoch %02d | Loss: %.4f | Val: %.4f | LR: %.6f | Time: %.2fs",
        epoch, train_loss, val_loss, lr, seconds,
    )


def render_timer_line(phase: Column, seconds: Column) -> Column:
    return F.format_string("[TIMER] Phase '%s' completed in %.2fs", phase, seconds)


def elapsed(seconds: Column) -> Column:
    """A duration as ``H:MM:SS``, days before it and microseconds behind it where there are any."""
    micros = F.round(seconds * 1_000_000).cast("bigint")
    whole = F.floor(micros / 1_000_000)
    days, rest = F.floor(whole / 86_400), F.pmod(micros, F.lit(1_000_000))
    clock = F.format_string("%d:%02d:%02d", F.floor(whole / 3_600) % 24, F.floor(whole / 60) % 60, whole % 60)
    named = F.when(days == 1, "1 day, ").when(days > 1, F.concat(days.cast("string"), F.lit(" days, "))).otherwise("")
    return F.concat(named, clock, F.when(rest > 0, F.format_string(".%06d", rest)).otherwise(""))
