"""Every operator as a registered query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapters as A
from quernstone.functions import runs as R
from quernstone.functions import text as T
from quernstone.functions import tokens as K
from quernstone.operators import codeindex, encoding, quality, refine, runs, sampling, vocab
from quernstone.plans import evaluation, refinery
from quernstone.session import scratch_path, stored
from quernstone.sources import jsonl, runlogs, sourcetree
from quernstone.streaming import refine_stream as stream

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = "*.txt.gz"
SEED = 7
BATCH = 32


# --- sources and sinks -----------------------------------------------------------------------


def _dirty(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    A.write_shards(A.dirty_lines(spark, sf), path)
    return jsonl.read_jsonl_shards(spark, path, shards=SHARDS)


def read_jsonl_shards(spark, sf):
    return _dirty(spark, sf).select("split", "raw")


def normalize_keys(spark, sf):
    return jsonl.normalize_keys(_dirty(spark, sf)).filter("NOT malformed").select("split", "code", "docstring")


def malformed_records(spark, sf):
    return jsonl.malformed_records(_dirty(spark, sf)).select("split", "raw")


def write_refined(spark, sf):
    path = scratch_path(spark, "refined")
    jsonl.write_refined(refined(spark, sf), path)
    return spark.read.schema("code string, docstring string, split string").json(path).select("split", "code", "docstring")


def preview(spark, sf):
    path = scratch_path(spark, "shards")
    A.write_shards(A.dirty_lines(spark, sf), path)
    return jsonl.preview(spark, path, 100, SHARDS)


def read_metrics(spark, sf):
    path = scratch_path(spark, "metrics")
    rows = A.metric_rows(spark, sf)
    fields = F.struct("file", "model", "bleu", "rougeL", "loss", "perplexity", "Subset", "`Mean Epoch (s)`")
    arrays = rows.groupBy(F.floor(F.col("run_id") / 100)).agg(F.to_json(F.collect_list(fields)).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    back = runlogs.read_metrics(spark, path)
    return back.select("file", "model", "bleu", "rougeL", "loss", "perplexity", F.col("Mean Epoch (s)").alias("mean_epoch"))


def _logs(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "logs")
    cores = spark.sparkContext.defaultParallelism
    runlogs.write_log_texts(A.log_parts(spark, sf).repartition(cores, "run_id", "part"), path)
    return path


def _title(text: str, group: int) -> Column:
    return F.regexp_extract(text, A.LOG_TITLE, group)


def read_logs(spark, sf):
    logs = runlogs.read_logs(spark, _logs(spark, sf))
    return logs.select(_title("content", 1).cast("bigint").alias("run_id"), _title("content", 2).cast("int").alias("part"), "content")


def write_run_records(spark, sf):
    path = scratch_path(spark, "records")
    records = runs.run_records(A.runs(spark, sf), A.epochs(spark, sf), A.LOG_PART)
    runlogs.write_run_files(runs.run_files(records), path)
    back = runlogs.read_run_records(spark, path, records.schema)
    return back.select(
        "run_id", "part", "metadata.*", F.col("durations")["model_training"].alias("model_training"),
        "evaluation.file", "evaluation.eval_mode", F.explode("training_history").alias("h"),
    ).select("*", "h.*").drop("h")


MODULE_DOCS = 64


def read_source_files(spark, sf):
    """A tree of module files of 64 consecutive documents each, with copies in an ignored folder."""
    path = scratch_path(spark, "tree")
    docs = A.table(spark, sf, "documents").select(F.expr(f"doc_id DIV {MODULE_DOCS}").alias("module"), "doc_id", "text")
    files = docs.groupBy("module").agg(F.sort_array(F.collect_list(F.struct("doc_id", "text"))).alias("d"))
    tree = files.select("module", F.array_join("d.text", "\n").alias("text"))
    for place in ("app", "app/venv/lib"):
        tree.write.partitionBy("module").text(f"{path}/src/{place}")
    back = sourcetree.read_source_files(spark, path, extension=".txt")
    inside = F.regexp_extract("path", "^src/(.*)/[^/]*$", 1)
    return back.select(inside.alias("folder"), "depth", "length", "source")


# --- row functions ---------------------------------------------------------------------------


def _on_docs(fn: Callable[[Column], Column]) -> Query:
    return lambda spark, sf: A.noisy_docs(spark, sf).select("id", fn(F.col("docstring")).alias("docstring"))


def _on_sources(fn: Callable[[Column], Column]) -> Query:
    return lambda spark, sf: A.sources(spark, sf).select("id", fn(F.col("source")).alias("code"))


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return A.pairs(spark, sf).select(
        "id", T.clean_code(F.col("code")).alias("code"), T.clean_docstring(F.col("docstring")).alias("doc")
    )


def _on_texts(**outputs: Callable[[Column, Column], Column]) -> Query:
    return lambda spark, sf: _texts(spark, sf).select(
        "id", *[make(F.col("code"), F.col("doc")).alias(name) for name, make in outputs.items()]
    )


def length_band(spark, sf):
    counted = _texts(spark, sf).select("id", T.word_count(F.col("code")).alias("c"), T.word_count(F.col("doc")).alias("d"))
    return counted.select("id", T.length_band(F.col("c"), F.col("d")).alias("in_band"))


def debug_filter(spark, sf):
    rows = A.pairs(spark, sf).select("id", "code", T.clean_docstring_firstline(F.col("docstring")).alias("doc"))
    return sampling.subset_first_n(rows.filter(T.debug_filter(F.col("doc"), F.col("code"))), 5)


def detok_cleanup(spark, sf):
    marked = F.replace("text", F.lit(" "), F.lit(" Ġ"))
    return A.documents(spark, sf).select(F.col("doc_id").alias("id"), T.detok_cleanup(marked).alias("text"))


def audit_line(spark, sf):
    return A.pairs(spark, sf).select("id", T.audit_line(F.col("code"), F.col("docstring")).alias("a")).select("id", "a.*")


def _odd_file() -> Column:
    return F.when(F.expr("run_id % 7 = 0"), F.format_string("net_%d.pt", "run_id")).otherwise(F.col("file"))


def model_tag(spark, sf):
    return A.runs(spark, sf).select(
        "run_id", R.model_tag(_odd_file()).alias("lenient"), R.model_tag_strict(_odd_file()).alias("strict")
    )


def subset_size(spark, sf):
    return A.runs(spark, sf).select("run_id", R.subset_size(_odd_file()).alias("subset_size"))


def run_short_name(spark, sf):
    path = F.format_string("logs/some.dir/20240101_093000_run_%d_B0.12.log", "run_id")
    return A.runs(spark, sf).select("run_id", R.run_short_name(path).alias("short_name"))


def run_slug(spark, sf):
    slug = R.run_slug(F.col("started"), F.col("model"), F.col("subset_size"), F.col("bleu"))
    return A.runs(spark, sf).select("run_id", slug.alias("slug"))


def to_numeric_coerce(spark, sf):
    return A.metric_rows(spark, sf).select("run_id", R.to_numeric_coerce(F.col("Mean Epoch (s)")).alias("mean_epoch"))


def throughput_features(spark, sf):
    return runs.metric_features(A.metric_rows(spark, sf)).select(
        "run_id", "subset_size", "mean_epoch", *[F.round(c, 6).alias(c) for c in ("throughput", "time_per_1k")]
    )


def render_epoch_line(spark, sf):
    fields = [F.col(c) for c in ("epoch", "train_loss", "val_loss", "lr", "seconds")]
    return A.epochs(spark, sf).select(
        "run_id", "epoch", R.render_epoch_line(*fields).alias("line"),
        R.render_timer_line(F.lit("epoch"), F.col("seconds")).alias("timer"),
    )


# --- joins and deduplication -----------------------------------------------------------------


def refine_rows(spark, sf):
    return refinery.refine_stored(A.pairs(spark, sf))


_PREPARED: dict[tuple[str, str], DataFrame] = {}


def prepare(spark: SparkSession, sf: str) -> None:
    """Store the refined rows of ``sf``, so that queries over them measure their own operator only."""
    _PREPARED[spark.sparkContext.applicationId, sf] = stored(refine_rows(spark, sf), "refined")


def refined(spark: SparkSession, sf: str) -> DataFrame:
    """Refined rows: the prepared table if there is one, else the refinery's own work."""
    ready = _PREPARED.get((spark.sparkContext.applicationId, sf))
    return refine_rows(spark, sf) if ready is None else ready


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    return refine.judge_pairs(A.pairs(spark, sf))


def reject_reason(spark, sf):
    return refine.reject_reason(refinery.store_judged(A.pairs(spark, sf)))


def dedup_train_keep_first(spark, sf):
    train = refine.gate_pairs(A.pairs(spark, sf).filter("split = 'train'"))
    return refine.dedup_keep_first(train.select("id", "fp"))


def cross_split_anti(spark, sf):
    return refine.cross_split_anti(refinery.store_gated(A.pairs(spark, sf), "id", "split", "fp"))


def leakage_pairs(spark, sf):
    return refine.leakage_pairs(refinery.store_gated(A.pairs(spark, sf), "id", "split", "fp"))


def refinery_audit(spark, sf):
    return refine.refinery_audit(_judged(spark, sf))


def classify_imports(spark, sf):
    imports = codeindex.extract_imports(A.sources(spark, sf).select("path", "source"))
    return codeindex.classify_imports(imports).select("path", "module", "relative", "kind")


# --- scores ----------------------------------------------------------------------------------


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return A.scored_pairs(refined(spark, sf))


def corpus_bleu(spark, sf):
    return quality.corpus_bleu(_scored(spark, sf), ["run"]).withColumn("bleu", F.round("bleu", 6))


def rouge_l_mean(spark, sf):
    return quality.rouge_l_mean(_scored(spark, sf), ["run"], stemmed=False).withColumn("rougeL", F.round("rougeL", 6))


def rouge_l_mean_stemmed(spark, sf):
    return quality.rouge_l_mean(_scored(spark, sf), ["run"], stemmed=True).withColumn("rougeL", F.round("rougeL", 6))


def loss_perplexity(spark, sf):
    rows = stored(_scored(spark, sf).select("run", "ref"), "scored")
    losses = quality.unigram_losses(rows, rows.filter(F.col("run") == "train"), "ref", ["run"])
    scored = quality.loss_perplexity(losses, ["run"], weight="n")
    return scored.select("run", F.round("loss", 6).alias("loss"), "n_tokens", F.round("perplexity", 4).alias("perplexity"))


def mean_of_batch_means(spark, sf):
    tokens = A.epochs(spark, sf).select(
        (F.col("run_id") % 3).alias("model_no"), "run_id", F.col("val_loss").alias("nll"),
        (F.col("epoch") % 5).alias("token_id"),
        F.struct("run_id", F.floor(F.col("epoch") / 10).alias("b")).alias("batch_id"),
    )
    return quality.mean_of_batch_means(tokens, ["model_no"]).withColumn("loss", F.round("loss", 6))


def batch_predict(spark, sf):
    rows = refined(spark, sf).withColumnRenamed("split", "run")
    return quality.batch_predict(rows, quality.keyword_scorer()).drop("error")


def evaluation_report(spark, sf):
    """Two runs scored on all refined rows."""
    scorers = {
        "20240101_0000_transformer_sub20000.pt": quality.keyword_scorer(12),
        "20240102_0000_lstm_dotproduct_sub50000.pt": quality.keyword_scorer(5),
    }
    report = evaluation.evaluate(refined(spark, sf), scorers, stemmed=False)
    return report.withColumns({c: F.round(c, 6) for c in ("bleu", "rougeL", "loss", "perplexity")})


# --- runs ------------------------------------------------------------------------------------


def best_epoch(spark, sf):
    return runs.best_epoch(A.epochs(spark, sf).withColumn("pos", F.col("epoch")))


def run_comparison(spark, sf):
    epochs = runs.parse_epochs(A.log_parts(spark, sf)).withColumn("pos", F.col("part") * A.LOG_PART + F.col("pos"))
    return runs.run_comparison(A.runs(spark, sf).select("run_id", "file"), epochs)


def mean_epoch_seconds(spark, sf):
    mean = runs.mean_epoch_seconds(runs.parse_epochs(A.log_parts(spark, sf)))
    return mean.withColumn("mean_epoch_seconds", F.round("mean_epoch_seconds", 6))


def metric_matrix(spark, sf):
    return runs.metric_matrix(A.metric_rows(spark, sf), "bleu")


def metric_matrix_mean_epoch(spark, sf):
    return runs.metric_matrix(runs.metric_features(A.metric_rows(spark, sf)), "mean_epoch")


def phase_durations(spark, sf):
    return runs.phase_durations(A.log_parts(spark, sf))


def model_subset_domains(spark, sf):
    return runs.model_subset_domains(A.metric_rows(spark, sf), "run_id")


def new_best_flag(spark, sf):
    return runs.new_best_flag(A.epochs(spark, sf)).select("run_id", "epoch", "val_loss", "new_best")


def select_runs_by_rank(spark, sf):
    return runs.select_runs_by_rank(A.runs(spark, sf), "2, 9, 1, 0, 1")


def sort_by_subset(spark, sf):
    return runs.sort_by_subset(A.metric_rows(spark, sf)).select("file", "subset_size", "bleu")


def parse_epochs(spark, sf):
    return runs.parse_epochs(A.log_parts(spark, sf)).select(
        "run_id", "part", "pos", "epoch", "train_loss", "val_loss", "seconds"
    )


def parse_epochs_lenient(spark, sf):
    lines = runlogs.read_log_lines(spark, _logs(spark, sf))
    titles = lines.filter(F.col("line").rlike(A.LOG_TITLE)).select("path", _title("line", 1).cast("bigint").alias("run_id"))
    return runs.parse_epochs_lenient(lines).join(titles, "path").drop("path")


def parse_run_metrics(spark, sf):
    return runs.parse_run_metrics(A.log_parts(spark, sf)).select("run_id", "part", "name", "bleu", "rougeL")


def _summary(logs: DataFrame, part_size: int = 0) -> DataFrame:
    entries = F.array_sort(F.map_entries("phases"))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.format_string("%.2f", e["value"]))), ",")
    return runs.run_summary(logs, part_size).withColumns({"mean_epoch_seconds": F.round("mean_epoch_seconds", 6), "phases": text})


def run_summary(spark, sf):
    return _summary(A.log_parts(spark, sf), A.LOG_PART)


def run_summary_files(spark, sf):
    """The same from log files, each of them a run of its own."""
    return _summary(runlogs.read_logs(spark, _logs(spark, sf))).drop("path", "name")


# --- code index ------------------------------------------------------------------------------


def _files(spark: SparkSession, sf: str) -> DataFrame:
    return A.sources(spark, sf).select("path", "source")


def extract_symbols(spark, sf):
    return codeindex.extract_symbols(_files(spark, sf)).select("path", "type", "name", "lineno", "args", "docstring")


def extract_imports(spark, sf):
    return codeindex.extract_imports(_files(spark, sf)).select("path", "module", "relative")


def import_counts(spark, sf):
    return codeindex.import_counts(codeindex.extract_imports(_files(spark, sf)))


def requirements_list(spark, sf):
    return codeindex.requirements_list(codeindex.extract_imports(_files(spark, sf)))


# --- subsets and samples ---------------------------------------------------------------------


def subset_first_n(spark, sf):
    budget = sampling.SCORING_BUDGETS["fast"]
    return sampling.subset_first_n(refined(spark, sf), budget).select("id", "split")


def sample_n_per_split(spark, sf):
    return sampling.sample_n_per_split(A.pairs(spark, sf), 10, SEED).select("id", "split")


def assign_batches(spark, sf):
    return sampling.assign_batches(A.pairs(spark, sf).select("id"), BATCH, SEED).select("id", "batch_id")


def assign_batches_in_order(spark, sf):
    return sampling.assign_batches(A.pairs(spark, sf).select("id"), BATCH).select("id", "batch_id")


def audit_suites(spark, sf):
    custom = A.table(spark, sf, "nation").select(
        (-1 - F.col("n_nationkey")).cast("bigint").alias("id"),
        F.concat(F.lit("return "), "n_name").alias("code"), F.lit("Name of a nation.").alias("docstring"),
    )
    return sampling.audit_suites(A.pairs(spark, sf), custom, 10, SEED)


# --- tokens ----------------------------------------------------------------------------------


def tokenizer_corpus(spark, sf):
    return vocab.tokenizer_corpus(refined(spark, sf))


def pretokenize(spark, sf):
    pieces = K.pretokenize(F.col("text"))
    split = A.documents(spark, sf).select(F.col("doc_id").alias("id"), pieces.alias("t"))
    return split.select("id", F.size("t").alias("n"), F.md5(F.array_join("t", "\x01")).alias("digest"))


def pretoken_counts(spark, sf):
    return vocab.pretoken_counts(A.documents(spark, sf), "text")


_TRAINED: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def _train(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The vocabulary of a folder, learned once per application."""
    key = spark.sparkContext.applicationId, sf
    if key not in _TRAINED:
        lines = vocab.tokenizer_corpus(refined(spark, sf))
        _TRAINED[key] = vocab.train_bpe(stored(vocab.pretoken_counts(lines), "pretokens"))
    return _TRAINED[key]


def train_bpe(spark, sf):
    return _train(spark, sf)[0]


def vocab_table(spark, sf):
    path = scratch_path(spark, "vocab")
    first = vocab.vocab_table(spark, path, lambda: _train(spark, sf))
    again = vocab.vocab_table(spark, path, lambda: _train(spark, sf))
    return vocab.vocab_info(first[0], first[2]).unionByName(vocab.vocab_info(again[0], again[2]))


def encode_bpe(spark, sf):
    rows = refined(spark, sf)
    encoder = encoding.bpe_encoder(*_train(spark, sf))
    return encoding.encode_pairs(rows, encoder).select("id", "split", *[
        F.array_join(c, " ").alias(c) for c in ("code_ids", "doc_ids")
    ])


SIDES = ("code_ids", "doc_ids")


def _word_ids(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Refined rows as word ids, stored, and the table of words."""
    rows = stored(refined(spark, sf), "refined")
    table = A.word_table(rows)
    return A.word_ids(rows, table), table


def _wrapped_ids(spark: SparkSession, sf: str) -> DataFrame:
    caps = dict(zip(SIDES, (K.MAX_CODE_IDS, K.MAX_DOC_IDS)))
    return _word_ids(spark, sf)[0].select("id", "split", *[K.wrap_ids(F.col(c), cap).alias(c) for c, cap in caps.items()])


def _shown(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, *[F.array_join(c, " ").alias(c) for c in SIDES])


def encode(spark, sf):
    return _shown(_wrapped_ids(spark, sf), "id", "split")


def _batched_ids(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.assign_batches(_wrapped_ids(spark, sf), BATCH)


def pad_batch(spark, sf):
    return _shown(encoding.pad_batch(_batched_ids(spark, sf), SIDES), "id", "batch_id")


def padding_economy(spark, sf):
    return encoding.padding_economy(_batched_ids(spark, sf), dict(zip(SIDES, (K.MAX_CODE_IDS, K.MAX_DOC_IDS))))


def decode(spark, sf):
    ids, table = _word_ids(spark, sf)
    special = spark.createDataFrame(list(enumerate(K.SPECIAL_TOKENS)), vocab.VOCAB_SCHEMA)
    both = stored(ids, "ids").select("id", F.concat(*SIDES).alias("ids"))
    return encoding.decode(both, special.unionByName(table)).select("id", "text")


# --- streaming -------------------------------------------------------------------------------


def refine_stream(spark, sf):
    root = scratch_path(spark, "arriving")
    A.write_shards(A.clean_lines(spark, sf), f"{root}/in")
    lines = stream.stream_shards(spark, f"{root}/in", SHARDS)
    stream.refine_stream(lines, f"{root}/out", f"{root}/state").awaitTermination()
    kept = stream.read_stream_output(spark, f"{root}/out")
    columns = ("split", "fp")
    return kept.groupBy(*columns).agg(F.count("*").alias("n"))


def queries() -> dict[str, Query]:
    return {
        "read_jsonl_shards": read_jsonl_shards,
        "normalize_keys": normalize_keys,
        "malformed_records": malformed_records,
        "write_refined": write_refined,
        "preview": preview,
        "read_metrics": read_metrics,
        "read_logs": read_logs,
        "write_run_records": write_run_records,
        "read_source_files": read_source_files,
        "first_paragraph": _on_docs(T.first_paragraph),
        "strip_doc_tags": _on_docs(T.strip_doc_tags),
        "strip_doctest": _on_docs(T.strip_doctest),
        "strip_urls": _on_docs(T.strip_urls),
        "collapse_ws": _on_docs(T.collapse_ws),
        "clean_docstring": _on_docs(T.clean_docstring),
        "strip_first_docstring": _on_sources(T.strip_first_docstring),
        "strip_comments": _on_sources(T.strip_comments),
        "drop_blank_lines": _on_sources(T.drop_blank_lines),
        "clean_code": _on_sources(T.clean_code),
        "word_count": _on_texts(code_words=lambda code, doc: T.word_count(code), doc_words=lambda code, doc: T.word_count(doc)),
        "has_alnum": _on_texts(has_alnum=lambda code, doc: T.has_alnum(doc)),
        "min_chars": _on_texts(min_chars=lambda code, doc: T.min_chars(code)),
        "length_band": length_band,
        "fingerprint": _on_texts(fp=lambda code, doc: T.fingerprint(code)),
        "reject_reason": reject_reason,
        "clean_docstring_firstline": _on_docs(T.clean_docstring_firstline),
        "debug_filter": debug_filter,
        "detok_cleanup": detok_cleanup,
        "audit_line": audit_line,
        "model_tag": model_tag,
        "subset_size": subset_size,
        "run_short_name": run_short_name,
        "run_slug": run_slug,
        "to_numeric_coerce": to_numeric_coerce,
        "throughput_features": throughput_features,
        "render_epoch_line": render_epoch_line,
        "dedup_train_keep_first": dedup_train_keep_first,
        "cross_split_anti": cross_split_anti,
        "leakage_pairs": leakage_pairs,
        "refine": refine_rows,
        "classify_imports": classify_imports,
        "refinery_audit": refinery_audit,
        "corpus_bleu": corpus_bleu,
        "rouge_l_mean": rouge_l_mean,
        "rouge_l_mean_stemmed": rouge_l_mean_stemmed,
        "loss_perplexity": loss_perplexity,
        "mean_of_batch_means": mean_of_batch_means,
        "best_epoch": best_epoch,
        "run_comparison": run_comparison,
        "mean_epoch_seconds": mean_epoch_seconds,
        "metric_matrix": metric_matrix,
        "metric_matrix_mean_epoch": metric_matrix_mean_epoch,
        "import_counts": import_counts,
        "requirements_list": requirements_list,
        "phase_durations": phase_durations,
        "model_subset_domains": model_subset_domains,
        "padding_economy": padding_economy,
        "new_best_flag": new_best_flag,
        "select_runs_by_rank": select_runs_by_rank,
        "subset_first_n": subset_first_n,
        "sample_n_per_split": sample_n_per_split,
        "sort_by_subset": sort_by_subset,
        "assign_batches": assign_batches,
        "assign_batches_in_order": assign_batches_in_order,
        "audit_suites": audit_suites,
        "tokenizer_corpus": tokenizer_corpus,
        "pretokenize": pretokenize,
        "pretoken_counts": pretoken_counts,
        "train_bpe": train_bpe,
        "encode": encode,
        "encode_bpe": encode_bpe,
        "pad_batch": pad_batch,
        "decode": decode,
        "vocab_table": vocab_table,
        "parse_epochs": parse_epochs,
        "parse_epochs_lenient": parse_epochs_lenient,
        "parse_run_metrics": parse_run_metrics,
        "run_summary": run_summary,
        "run_summary_files": run_summary_files,
        "extract_symbols": extract_symbols,
        "extract_imports": extract_imports,
        "batch_predict": batch_predict,
        "evaluation_report": evaluation_report,
        "refine_stream": refine_stream,
    }
