"""Analytics over training runs: log extraction, best epochs, comparisons, matrices, selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quernstone.functions import runs as R

# Patterns of the log formats.
EPOCH = r"(?i)Epoch\s+(\d+)\s+\|\s+Loss:\s+([\d.]+)\s+\|\s+Val:\s+([\d.]+)"
EPOCH_LENIENT = r"(?d)Epoch\s+(\d+).*?Val:\s+([\d.]+)"
SECONDS = r"Time:\s+([\d.]+)s"
TIMER = r"\[TIMER\] Phase '([^']+)' completed in ([\d.]+)s"
BLEU = r"""(?i)["']?bleu["']?\s*[:=]\s*([\d.]+)"""
BLEU_FULL = r"""(?i)["']?bleu["']?\s*[:=]\s*([\d.]+(?:[eE][-+]?\d+)?)"""
ROUGE_L = r"""(?i)["']?rougeL["']?\s*[:=]\s*([\d.]+)"""
ROUGE_L_FULL = r"""(?i)["']?rougeL["']?\s*[:=]\s*([\d.]+(?:[eE][-+]?\d+)?)"""
FILE_FIELD = r'(?i)"file"\s*:\s*"([^"]+)"'

NO_DATA = "NO DATA FOUND"


def _number(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(text, pattern, group).try_cast("double")


def _keys(df: DataFrame, *drop: str) -> list[str]:
    return [c for c in df.columns if c not in drop]


# --- log extraction --------------------------------------------------------------------------


def _epoch_fields(hit: Column) -> list[Column]:
    return [
        F.regexp_extract(hit, EPOCH, 1).try_cast("int").alias("epoch"),
        _number(hit, EPOCH, 2).alias("train_loss"),
        _number(hit, EPOCH, 3).alias("val_loss"),
        _number(hit, SECONDS, 1).alias("seconds"),
    ]


def _epoch_hits() -> Column:
    tail = r"(?:[^\n]*?\|\s+" + SECONDS + ")?"
    return F.regexp_extract_all("content", F.lit(EPOCH + tail), F.lit(0))


def parse_epochs(logs: DataFrame) -> DataFrame:
    """One row per epoch entry of a log text, with its position in the file from 1."""
    keys = _keys(logs, "content")
    hits = logs.select(*keys, F.posexplode(_epoch_hits()).alias("_pos", "_hit"))
    return hits.select(*keys, (F.col("_pos") + 1).alias("pos"), *_epoch_fields(F.col("_hit")))


def parse_epochs_lenient(lines: DataFrame) -> DataFrame:
    """Epoch and validation loss of every line that has both, whatever stands between."""
    keys = _keys(lines, "line")
    return lines.filter(F.col("line").rlike(EPOCH_LENIENT)).select(
        *keys,
        F.regexp_extract("line", EPOCH_LENIENT, 1).try_cast("int").alias("epoch"),
        _number(F.col("line"), EPOCH_LENIENT, 2).alias("val_loss"),
    )


def _run_name() -> Column:
    named = F.nullif(F.regexp_extract("content", FILE_FIELD, 1), F.lit(""))
    return F.coalesce(F.replace(named, F.lit(".pt"), F.lit("")), R.run_short_name(F.col("path")))


def _metric(pattern: str) -> Column:
    return _number(F.col("content"), pattern, 1)


def parse_run_metrics(logs: DataFrame) -> DataFrame:
    """Run name and first scores of a log; the ``_full`` columns also read exponents."""
    keys = _keys(logs, "content", "path")
    return logs.select(
        *keys,
        _run_name().alias("name"),
        _metric(BLEU).alias("bleu"),
        _metric(ROUGE_L).alias("rougeL"),
        _metric(BLEU_FULL).alias("bleu_full"),
        _metric(ROUGE_L_FULL).alias("rougeL_full"),
    )


def _run_of(logs: DataFrame, run: str | None) -> str:
    """The column that tells runs apart: the one asked for, else ``run_id``, else the file."""
    return run or ("run_id" if "run_id" in logs.columns else "path")


def _part_of(logs: DataFrame) -> Column:
    """Number of the file within its run; a run is one file unless ``part`` says otherwise."""
    return F.col("part").cast("bigint") if "part" in logs.columns else F.lit(0).cast("bigint")


def phase_durations(logs: DataFrame, run: str | None = None) -> DataFrame:
    """``run, phase, seconds, total_seconds`` for every phase a log names; a repeated phase counts once, last."""
    key = _run_of(logs, run)
    hits = logs.select(key, _part_of(logs).alias("_part"), F.posexplode(F.regexp_extract_all("content", F.lit(TIMER), F.lit(0))))
    timed = hits.select(
        key, F.struct("_part", "pos").alias("at"), F.regexp_extract("col", TIMER, 1).alias("phase"), _number(F.col("col"), TIMER, 2).alias("seconds")
    )
    last = timed.groupBy(key, "phase").agg(F.max_by("seconds", "at").alias("seconds"))
    return last.withColumn("total_seconds", F.coalesce(F.sum("seconds").over(W.partitionBy(key)), F.lit(0.0)))


def run_summary(logs: DataFrame, part_size: int = 0, run: str | None = None) -> DataFrame:
    """One row per run: name, scores, best epoch, number of epochs, mean epoch, training time, all phases.

    ``logs`` are what :func:`quernstone.sources.runlogs.read_logs` returns, a file per run, or have
    ``run_id`` and ``part`` for runs in several files of ``part_size`` epochs. Each file is reduced to a
    single row with array functions, so the only shuffle carries one small row per file. The first
    score counts; an epoch whose loss cannot be read is no candidate for the best.
    """
    key, part = _run_of(logs, run), _part_of(logs)
    entry = F.transform(_epoch_hits(), lambda h, i: F.struct(
        _number(h, EPOCH, 3).alias("val_loss"),
        (part * part_size + i + 1).alias("pos"),
        _number(h, SECONDS, 1).alias("seconds"),
    ))
    phases = F.transform(F.regexp_extract_all("content", F.lit(TIMER), F.lit(0)), lambda h: F.struct(
        F.regexp_extract(h, TIMER, 1).alias("phase"), _number(h, TIMER, 2).alias("seconds"),
    ))
    files = logs.select(
        F.col(key), part.alias("_part"), F.when(part == 0, _run_name()).alias("name"),
        _metric(BLEU).alias("bleu"), _metric(ROUGE_L).alias("rougeL"), entry.alias("_epochs"), phases.alias("_phases"),
    ).select(
        "*",
        F.array_min(F.filter("_epochs", lambda e: e["val_loss"].isNotNull())).alias("_best"),
        F.size("_epochs").alias("_n"),
        F.aggregate("_epochs", F.lit(0.0), lambda acc, e: acc + F.coalesce(e["seconds"], F.lit(0.0))).alias("_s"),
    )

    def first(name: str) -> Column:
        return F.min_by(name, F.when(F.col(name).isNotNull(), F.col("_part"))).alias(name)

    best = F.min("_best")
    timed = F.flatten(F.sort_array(F.collect_list(F.struct("_part", "_phases")))["_phases"])
    known = F.aggregate(timed, F.expr("cast(map() AS map<string,double>)"), lambda m, e: F.map_concat(
        F.map_filter(m, lambda k, _: k != e["phase"]), F.create_map(e["phase"], e["seconds"])))
    summed = files.groupBy(key).agg(
        F.max("name").alias("name"), first("bleu"), first("rougeL"),
        best["pos"].alias("best_epoch"),
        best["val_loss"].alias("min_val_loss"),
        F.sum("_n").alias("n_epochs"),
        F.try_divide(F.sum("_s"), F.sum("_n")).alias("mean_epoch_seconds"),
        known.alias("phases"),
    )
    return summed.withColumn("training_seconds", F.try_element_at("phases", F.lit("model_training")))


# --- per-run aggregates ----------------------------------------------------------------------


def best_epoch(epochs: DataFrame, run: str = "run_id") -> DataFrame:
    """Epoch with the lowest validation loss, earliest on ties: list position and logged number."""
    order = F.struct("val_loss", "pos")
    return epochs.groupBy(run).agg(
        F.min_by("pos", order).alias("best_position"),
        F.min_by("epoch", order).alias("best_epoch"),
        F.min("val_loss").alias("min_val_loss"),
    )


def run_comparison(run_list: DataFrame, epochs: DataFrame, run: str = "run_id") -> DataFrame:
    """Lowest validation loss (4 decimals) and final epoch for every listed run."""
    figures = epochs.groupBy(run).agg(
        F.min("val_loss").alias("_low"), F.max_by("epoch", "pos").alias("final_epoch")
    )
    low = F.coalesce(F.format_string("%.4f", F.round("_low", 4)), F.lit(NO_DATA))
    shown = F.when(F.col("_low").isNull(), NO_DATA).otherwise(low)
    return run_list.join(figures, run, "left").select(
        *run_list.columns, shown.alias("min_val_loss"), "final_epoch"
    )


def mean_epoch_seconds(epochs: DataFrame, run: str = "run_id") -> DataFrame:
    return epochs.groupBy(run).agg(F.avg("seconds").alias("mean_epoch_seconds"))


def metric_matrix(
    metrics: DataFrame, value: str, subsets: Sequence[int] | None = None, first_by: str = "file"
) -> DataFrame:
    """Model by subset size; the first value in file order, 0 where there is none.

    Without ``subsets`` every size that occurs gets a column, in ascending order.
    """
    if subsets is None:
        found = metrics.select("subset_size").distinct().filter("subset_size IS NOT NULL")
        subsets = sorted(r[0] for r in found.collect())
    cells = metrics.groupBy("model").pivot("subset_size", list(subsets)).agg(F.min_by(value, first_by))
    return cells.select(
        "model", *[F.coalesce(F.col(f"`{s}`"), F.lit(0.0)).alias(f"s{s}") for s in subsets]
    )


def metric_features(metrics: DataFrame) -> DataFrame:
    """Add subset size, numeric mean epoch, throughput and time per thousand rows."""
    size, mean = F.col("subset_size"), F.col("mean_epoch")
    return (
        metrics.withColumn("subset_size", R.subset_size(F.col("file")))
        .withColumn("mean_epoch", R.to_numeric_coerce(F.col("Mean Epoch (s)")))
        .withColumn("throughput", R.throughput(size, mean))
        .withColumn("time_per_1k", R.time_per_1k(size, mean))
    )


def model_subset_domains(metrics: DataFrame, pos: str) -> DataFrame:
    """Axis values: models in order of first appearance, subset sizes ascending."""
    models = metrics.groupBy(F.col("model").alias("value")).agg(F.min(pos).cast("bigint").alias("sort_key"))
    sizes = metrics.select("subset_size").distinct().select(
        F.col("subset_size").cast("string").alias("value"), F.col("subset_size").cast("bigint").alias("sort_key")
    )
    axes = models.withColumn("axis", F.lit("model")).unionByName(sizes.withColumn("axis", F.lit("subset_size")))
    rank = F.row_number().over(W.partitionBy("axis").orderBy("sort_key"))
    return axes.select("axis", rank.alias("ord"), "value")


def sort_by_subset(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("subset_size", "file")


# --- order within a run ----------------------------------------------------------------------


def new_best_flag(epochs: DataFrame, run: str = "run_id", width: int = 65_536) -> DataFrame:
    """Flag epochs whose validation loss lies strictly below that of every earlier one.

    A run of any length is cut into blocks of ``width`` epoch numbers. The lowest value of earlier
    blocks comes from a small aggregate, so no task has to walk a whole long run.
    """
    rows = epochs.withColumn("_block", F.expr(f"epoch DIV {width}"))
    earlier = W.partitionBy(run).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    before = (
        rows.groupBy(run, "_block").agg(F.min("val_loss").alias("_low"))
        .select(run, "_block", F.min("_low").over(earlier).alias("_before"))
    )
    inside = W.partitionBy(run, "_block").orderBy("epoch").rowsBetween(W.unboundedPreceding, -1)
    bar = F.least(F.col("_before"), F.min("val_loss").over(inside))
    flag = F.col("val_loss") < F.coalesce(bar, F.lit(float("inf")))
    return rows.join(before, [run, "_block"]).withColumn("new_best", flag).drop("_block", "_before")


def parse_selection(spec: str) -> list[int] | None:
    """1-based ranks in a selection such as ``"1,2,4"``; None for ``all``."""
    if spec.lower() == "all":
        return None
    return [int(part.strip()) for part in spec.split(",")]


def select_runs_by_rank(files: DataFrame, spec: str, name: str = "file", suffix: str = ".pt") -> DataFrame:
    """Pick saved runs by rank, newest name first: ``pick`` (order asked for) and the name.

    Ranks that do not exist are dropped and repeated ones stay repeated. Only the names down to the
    lowest rank asked for are ranked. For ``all`` every name comes back, sorted, without a pick.
    """
    saved = files.filter(F.col(name).endswith(suffix)).select(name)
    ranks = parse_selection(spec)
    if ranks is None:
        return saved.orderBy(F.desc(name)).select(F.lit(None).cast("int").alias("pick"), name)
    wanted = [(i, r) for i, r in enumerate(ranks, 1) if r >= 1]
    asked = saved.sparkSession.createDataFrame(wanted, "pick int, _rank int")
    top = saved.orderBy(F.desc(name)).limit(max((r for _, r in wanted), default=0))
    ranked = top.withColumn("_rank", F.row_number().over(W.orderBy(F.desc(name))))
    return ranked.join(asked, "_rank").select("pick", name)


# --- run records -----------------------------------------------------------------------------


def run_records(
    run_table: DataFrame, epochs: DataFrame, part_size: int, mode: str = "fast", phases: DataFrame | None = None
) -> DataFrame:
    """Nested run records; a run longer than ``part_size`` epochs continues in further records.

    A run without epochs has one record with an empty history. ``phases`` (``run_id, phase, seconds``, as
    from :func:`phase_durations`) fill the durations; without them the total time is the training's.
    ``total_execution`` is what all of them take together.
    ``tokenizer`` and ``infrastructure`` columns of ``run_table`` become blocks of the record.
    """
    shown = F.format_string("%.2fs", "seconds")
    history = (
        epochs.withColumn("part", F.expr(f"(epoch - 1) DIV {part_size}").cast("int"))
        .groupBy("run_id", "part")
        .agg(F.sort_array(F.collect_list(
            F.struct("epoch", "train_loss", "val_loss", "lr", shown.alias("duration"))
        )).alias("training_history"))
    )
    durations, spent = F.create_map(F.lit("model_training"), F.format_string("%.2fs", "total_seconds")), F.col("total_seconds")
    if phases is not None:
        named = phases.groupBy("run_id").agg(
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("phase", shown)))).alias("_durations"), F.sum("seconds").alias("_spent")
        )
        run_table = run_table.join(named, "run_id", "left")
        durations, spent = F.coalesce("_durations", F.expr("cast(map() AS map<string,string>)")), F.col("_spent")
    durations = F.map_concat(durations, F.create_map(F.lit("total_execution"), R.elapsed(F.coalesce(spent, F.lit(0.0)))))
    subset = F.when(F.col("subset_size") == 0, "ALL").otherwise(F.col("subset_size").cast("string"))
    started = F.date_format("started", "yyyy-MM-dd'T'HH:mm:ss")
    empty = F.array().cast(history.schema["training_history"].dataType)
    metadata = [F.col("model").alias("model_type"), subset.alias("subset"), started.alias("start_time")]
    return run_table.join(history, "run_id", "left").select(
        "run_id",
        F.coalesce("part", F.lit(0)).alias("part"),
        F.struct(*metadata, *[c for c in ("tokenizer",) if c in run_table.columns]).alias("metadata"),
        durations.alias("durations"),
        *[c for c in ("infrastructure",) if c in run_table.columns],
        F.coalesce("training_history", empty).alias("training_history"),
        F.struct("file", "model", "bleu", "rougeL", F.lit(mode).alias("eval_mode")).alias("evaluation"),
    )


def run_files(records: DataFrame) -> DataFrame:
    """``name, json, log``: the two files of each record of :func:`run_records`.

    The name is the archive name of the run (:func:`quernstone.functions.runs.run_slug`), with the run's id
    behind it where several runs have that name, and the part behind that from the second part on. The log
    says what the record says in lines that :func:`run_summary` reads.
    """
    entry = F.col("metadata")
    slug = R.run_slug(F.to_timestamp(entry["start_time"]), entry["model_type"], entry["subset"].try_cast("int"), F.col("evaluation.bleu"))
    named = records.select("*", F.regexp_replace(slug, r"[^A-Za-z0-9._-]", "_").alias("_slug"))
    shared = named.groupBy("_slug").agg((F.min("run_id") != F.max("run_id")).alias("_shared"))
    name = F.concat(
        "_slug", F.when(F.col("_shared"), F.concat(F.lit("_"), F.col("run_id").cast("string"))).otherwise(""),
        F.when(F.col("part") > 0, F.format_string("_P%d", "part")).otherwise(""),
    )
    epochs = F.transform("training_history", lambda h: F.format_string(
        "Epoch %02d | Loss: %.4f | Val: %.4f | LR: %.6f | Time: %s", h["epoch"], h["train_loss"], h["val_loss"], h["lr"], h["duration"]
    ))
    spent = F.map_filter("durations", lambda k, _: k != "total_execution")
    timers = F.transform(F.map_entries(spent), lambda e: F.format_string("[TIMER] Phase '%s' completed in %s", e["key"], e["value"]))
    pretty = {"pretty": "true"}
    later = F.col("part") > 0
    log = F.concat_ws(
        "\n",
        F.format_string("RUN %s PART %d", F.col("run_id").cast("string"), "part"),
        F.when(~later, F.array_join(timers, "\n")), F.nullif(F.array_join(epochs, "\n"), F.lit("")),
        F.when(~later, F.concat(F.lit("--- FINAL EVALUATION ("), F.upper("evaluation.eval_mode"), F.lit(") ---"))),
        F.when(~later, F.to_json("evaluation", pretty)),
        F.lit("--- FINISHED ---"), F.concat(F.lit("Total Duration: "), F.col("durations")["total_execution"]),
    )
    whole = F.to_json(F.struct(*records.columns), pretty)
    return named.join(shared, "_slug").select(name.alias("name"), whole.alias("json"), log.alias("log"))
