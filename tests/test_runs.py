"""Run analytics on hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from quernstone.functions import runs as R
from quernstone.operators import runs
from quernstone.sources import runlogs

LOG = """[TIMER] Phase 'data_cleaning' completed in 0.12s
Epoch 01 | Loss: 7.2972 | Val: 7.3937 | LR: 0.000052 | Time: 840.97s
epoch 02 | loss: 6.7 | val: 7.1 | LR: 0.000140 | Time: 768.78s
Epoch 03 | Loss: 6.6 | Val: 7.1
Epoch 4 early Val: 9.5
[TIMER] Phase 'model_training' completed in 100.50s
[TIMER] Phase 'model_training' completed in 101.50s
{
    "file": "20260201_2100_lstm_sub50000.pt",
    "bleu": 4.4e-05,
    'rougeL' = 0.25,
}
"""


@pytest.fixture(scope="module")
def logs(spark):
    return spark.createDataFrame(
        [(1, 0, "a/20260201_210033_LSTM_B0.1.log", LOG), (2, 0, "a/b/20260201_210033_none.x.log", "nothing\n")],
        "run_id bigint, part int, path string, content string",
    )


def test_epochs(logs):
    rows = runs.parse_epochs(logs).orderBy("pos").collect()
    assert [(r.pos, r.epoch, r.train_loss, r.val_loss, r.seconds) for r in rows] == [
        (1, 1, 7.2972, 7.3937, 840.97), (2, 2, 6.7, 7.1, 768.78), (3, 3, 6.6, 7.1, None)]


def test_lenient_epochs_are_case_sensitive(spark):
    lines = spark.createDataFrame([(line,) for line in LOG.split("\n")], "line string")
    rows = runs.parse_epochs_lenient(lines).orderBy("epoch").collect()
    assert [(r.epoch, r.val_loss) for r in rows] == [(1, 7.3937), (3, 7.1), (4, 9.5)]


def test_run_metrics(logs):
    full, empty = runs.parse_run_metrics(logs).orderBy("run_id").collect()
    assert (full.name, full.bleu, full.bleu_full, full.rougeL) == ("20260201_2100_lstm_sub50000", 4.4, 4.4e-05, 0.25)
    assert (empty.name, empty.bleu, empty.rougeL) == ("none.x", None, None)


def test_phases_and_summary(logs):
    rows = runs.phase_durations(logs).collect()
    assert {(r.run_id, r.phase, r.seconds, round(r.total_seconds, 2)) for r in rows} >= {(1, "data_cleaning", 0.12, 101.62), (1, "model_training", 101.5, 101.62)}
    full, empty = runs.run_summary(logs, 1000).orderBy("run_id").collect()
    assert (full.best_epoch, full.min_val_loss, full.n_epochs) == (2, 7.1, 3)
    assert (empty.best_epoch, empty.n_epochs, empty.name) == (None, 0, "none.x")
    assert full.phases["data_cleaning"] == 0.12 and full.training_seconds == 101.5


def test_logs_from_files_to_a_summary(spark, tmp_path):
    (tmp_path / "a.log").write_text(
        "[TIMER] Phase 'setup' completed in 5.00s\n[TIMER] Phase 'extra step' completed in 7.00s\n[TIMER] Phase 'setup' completed in 6.00s\n"
        "Epoch 01 | Loss: 3.0 | Val: 4.0 | Time: 1.00s\nEpoch 02 | Loss: 2.0 | Val: 1.2.3 | Time: 1.00s\nEpoch 03 | Loss: 1.0 | Val: 2.0 | Time: 4.00s\n"
        'bleu: 0.5\nbleu: 0.9\n')
    (tmp_path / "b.log").write_text("nothing here\n")
    logs = runlogs.read_logs(spark, str(tmp_path))
    got = {r.name: r for r in runs.run_summary(logs).collect()}
    assert (got["a"].best_epoch, got["a"].min_val_loss, got["a"].n_epochs, got["a"].mean_epoch_seconds) == (3, 2.0, 3, 2.0)
    assert got["a"].phases == {"setup": 6.0, "extra step": 7.0} and got["a"].bleu == 0.5
    assert (got["b"].best_epoch, got["b"].n_epochs, got["b"].phases) == (None, 0, {})
    phases = {(r.phase, r.seconds, r.total_seconds) for r in runs.phase_durations(logs).collect()}
    assert phases == {("setup", 6.0, 13.0), ("extra step", 7.0, 13.0)}


def epochs_of(spark, values):
    return spark.createDataFrame(
        [(1, i, i + 10, v) for i, v in enumerate(values, 1)], "run_id int, pos int, epoch int, val_loss double")


def test_best_epoch_takes_the_earliest_tie(spark):
    row = runs.best_epoch(epochs_of(spark, [3.0, 1.0, 2.0, 1.0])).first()
    assert (row.best_position, row.best_epoch, row.min_val_loss) == (2, 12, 1.0)


def test_comparison_lists_runs_without_rows(spark):
    listed = spark.createDataFrame([(1, "one"), (2, "two")], "run_id int, label string")
    rows = runs.run_comparison(listed, epochs_of(spark, [3.0, 1.25])).orderBy("run_id").collect()
    assert [(r.label, r.min_val_loss, r.final_epoch) for r in rows] == [("one", "1.2500", 12), ("two", runs.NO_DATA, None)]


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_new_best_in_blocks(spark, width):
    values = [random.Random(5).choice([5.0, 4.0, 3.0, 2.0, 1.0]) + i % 3 for i in range(40)]
    rows = runs.new_best_flag(epochs_of(spark, values), width=width).orderBy("epoch").collect()
    low, want = float("inf"), []
    for v in values:
        want.append(v < low)
        low = min(low, v)
    assert [r.new_best for r in rows] == want


@pytest.mark.parametrize("spec, want", [
    ("2, 9,1,1", [(1, "b.pt"), (3, "c.pt"), (4, "c.pt")]), ("0", []), ("-1,3", [(2, "a.pt")]),
    ("ALL", [(None, "c.pt"), (None, "b.pt"), (None, "a.pt")]),
])
def test_selection(spark, spec, want):
    files = spark.createDataFrame([("a.pt",), ("c.pt",), ("x.log",), ("b.pt",)], "file string")
    got = [(r.pick, r.file) for r in runs.select_runs_by_rank(files, spec).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_bad_selection(spark):
    with pytest.raises(ValueError):
        runs.select_runs_by_rank(spark.createDataFrame([("a.pt",)], "file string"), "x")


def test_scalar_rules(spark):
    one = spark.range(1)

    def value(column):
        return one.select(column).first()[0]

    assert value(R.score_tag(F.lit(0.0001))) == "NA" and value(R.score_tag(F.lit(0.005))).startswith("B0.0")
    assert value(R.perplexity(F.lit(100.0))) == float("inf") and value(R.perplexity(F.lit(99.9))) < float("inf")
    assert [value(R.to_numeric_coerce(F.lit(t))) for t in ("1.5", "n/a", "nan", None)] == [1.5, 0.0, 0.0, 0.0]
    assert value(R.throughput(F.lit(10), F.lit(0.0))) is None and value(R.time_per_1k(F.lit(0), F.lit(2.0))) is None
    assert value(R.model_tag(F.lit("my_Transformer_lstm_dotproduct.pt"))) == "transformer"
    assert value(R.model_tag(F.lit("other.pt"))) == "lstm_bahdanau" and value(R.model_tag_strict(F.lit("other.pt"))) is None
    assert value(R.subset_size(F.lit("x_SUB070_sub5.pt"))) == 70 and value(R.subset_size(F.lit("suball.pt"))) == 0
    slug = R.run_slug(F.lit("2024-01-02 03:04:05").cast("timestamp"), F.lit("transformer"), F.lit(None).cast("int"), F.lit(0.126))
    assert value(slug) == "20240102_030405_TRANS_SALL_B0.13"


def test_matrix_fills_gaps_and_takes_the_first_file(spark):
    rows = spark.createDataFrame(
        [("b", "m", 20, 2.0), ("a", "m", 20, 1.0), ("c", "n", 50, 3.0)], "file string, model string, subset_size int, bleu double")
    got = {r.model: (r.s20, r.s50) for r in runs.metric_matrix(rows, "bleu", [20, 50]).collect()}
    assert got == {"m": (1.0, 0.0), "n": (0.0, 3.0)}
    more = rows.unionByName(rows.limit(1).withColumn("subset_size", F.lit(99).cast(rows.schema["subset_size"].dataType)))
    assert runs.metric_matrix(more, "bleu").columns == ["model", "s20", "s50", "s99"]


def test_long_runs_continue_in_further_records(spark):
    epochs = spark.range(1, 8).select(
        F.lit(1).alias("run_id"), F.col("id").cast("int").alias("epoch"), F.lit(1.0).alias("train_loss"),
        F.lit(2.0).alias("val_loss"), F.lit(0.1).alias("lr"), F.lit(3.456).alias("seconds"))
    table = spark.createDataFrame([(1, "m", 0, "f.pt", 0.1, 0.2, 9.0)],
                                  "run_id int, model string, subset_size int, file string, bleu double, rougeL double, total_seconds double")
    table = table.withColumn("started", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    rows = runs.run_records(table, epochs, 3).orderBy("part").collect()
    assert [[h.epoch for h in r.training_history] for r in rows] == [[1, 2, 3], [4, 5, 6], [7]]
    assert rows[0].training_history[0].duration == "3.46s" and rows[0].metadata.subset == "ALL"
    [bare] = runs.run_records(table, epochs.limit(0), 3).collect()
    assert (bare.part, bare.training_history, bare.evaluation.file) == (0, [], "f.pt")
    phases = spark.createDataFrame([(1, "setup", 1.5), (1, "training", 2.0)], "run_id int, phase string, seconds double")
    full = table.withColumn("tokenizer", F.struct(F.lit("REUSED").alias("status"))).withColumn("infrastructure", F.create_map(F.lit("gpu"), F.lit("T4")))
    [record] = runs.run_records(full, epochs.limit(0), 3, phases=phases).collect()
    assert record.durations == {"setup": "1.50s", "training": "2.00s", "total_execution": "0:00:03.500000"}
    assert record.metadata.tokenizer.status == "REUSED" and record.infrastructure == {"gpu": "T4"}


def test_numbers_with_type_letters_do_not_count(spark):
    rows = spark.createDataFrame([(t,) for t in ("12d", "12f", "1.5", " -2e1 ", "x", None, "nan")], "t string")
    assert [r[0] for r in rows.select(R.to_numeric_coerce(F.col("t"))).collect()] == [0.0, 0.0, 1.5, -20.0, 0.0, 0.0, 0.0]


def test_elapsed(spark):
    from datetime import timedelta

    seconds = [0.0, 9.0, 61.5, 3600.25, 86_399.999999, 86_400.0, 200_000.0, 1e-6]
    rows = spark.createDataFrame([(x,) for x in seconds], "s double").select(R.elapsed(F.col("s")))
    assert [r[0] for r in rows.collect()] == [str(timedelta(seconds=x)) for x in seconds]


def records_of_three_runs(spark):
    epochs = spark.range(1, 15).select(
        (F.col("id") % 2).cast("int").alias("run_id"), F.ceil(F.col("id") / 2).cast("int").alias("epoch"), F.lit(1.0).alias("train_loss"),
        (F.col("id") / 4).alias("val_loss"), F.lit(0.1).alias("lr"), F.lit(3.0).alias("seconds"))
    table = spark.createDataFrame(
        [(0, "lstm", 20000, "0_lstm_sub20000.pt", 0.25, 0.5, 21.0), (1, "lstm", 20000, "1_lstm_sub20000.pt", 0.25, 0.75, 21.0), (2, "gru/x", 0, "2.pt", 0.0, 0.0, 0.0)],
        "run_id int, model string, subset_size int, file string, bleu double, rougeL double, total_seconds double")
    return runs.run_records(table.withColumn("started", F.lit("2024-01-02 03:04:05").cast("timestamp")), epochs, 5)


def test_run_files_round_trip(spark, tmp_path):
    path, records = str(tmp_path / "runs"), records_of_three_runs(spark)
    for _ in range(2):
        assert runlogs.write_run_files(runs.run_files(records), path) == 10
    stem = "20240102_030405_LSTM_S20000_B0.25"
    names = [*[f"{stem}_{k}{p}" for k in (0, 1) for p in ("", "_P1")], "20240102_030405_GRU_X_SALL_NA"]
    found = sorted(f.name for f in (tmp_path / "runs").iterdir() if not f.name.startswith((".", "_")))
    assert found == sorted(f"{n}.{kind}" for n in names for kind in ("json", "log")) and not list((tmp_path / "runs").glob("_staging*"))
    back = runlogs.read_run_records(spark, path, records.schema)
    order = ["run_id", "part"]
    assert back.orderBy(order).collect() == records.orderBy(order).collect()
    logs = runlogs.read_logs(spark, f"{path}/*.log").withColumn("run_id", F.regexp_extract("content", r"RUN (\d+) PART (\d+)", 1).cast("int"))
    logs = logs.withColumn("part", F.regexp_extract("content", r"RUN (\d+) PART (\d+)", 2).cast("int"))
    summary = {r.run_id: r for r in runs.run_summary(logs, 5).collect()}
    assert (summary[1].name, summary[1].bleu, summary[1].rougeL) == ("1_lstm_sub20000", 0.25, 0.75)
    epochs = {(r.run_id, r.part): r["count"] for r in runs.parse_epochs(logs).groupBy("run_id", "part").count().collect()}
    assert epochs == {(0, 0): 5, (0, 1): 2, (1, 0): 5, (1, 1): 2}
    assert {r.run_id: r.total_seconds for r in runs.phase_durations(logs).collect()} == {0: 21.0, 1: 21.0, 2: 0.0}


def test_run_files_are_moved_by_tasks(spark, tmp_path, monkeypatch):
    """On a mounted file system the driver moves nothing; odd names, nulls and checksums of older files are seen to."""
    monkeypatch.setattr(runlogs, "_write_remote", lambda *_: pytest.fail("moved by the driver"))
    rows = [("a/b:c", "x", "y"), (None, None, "n\u00e9"), ("plain", "{}", "")]
    path = tmp_path / "runs"
    spark.createDataFrame([("old",)], "value string").coalesce(1).write.text(f"file:{path}")
    old = next(path.glob("part-*"))
    old.rename(path / "plain.json")
    (path / f".{old.name}.crc").rename(path / ".plain.json.crc")
    files = spark.createDataFrame(rows, "name string, json string, log string")
    assert runlogs.write_run_files(files, f"file:{path}") == 6
    found = {f.name: f.read_text() for f in path.iterdir() if f.name.endswith((".json", ".log"))}
    assert found == {
        "a%2Fb%3Ac.json": "x\n", "a%2Fb%3Ac.log": "y\n", "__HIVE_DEFAULT_PARTITION__.json": "\n",
        "__HIVE_DEFAULT_PARTITION__.log": "n\u00e9\n", "plain.json": "{}\n", "plain.log": "\n"}
    assert spark.read.text(f"{path}/plain.json").first()[0] == "{}" and not list(path.glob("_staging*"))
    assert runlogs.write_run_files(files.limit(0), str(tmp_path / "none")) == 0 and (tmp_path / "none").is_dir()


def test_a_failed_task_leaves_no_run_file(spark, tmp_path):
    path = tmp_path / "runs"
    files = runs.run_files(records_of_three_runs(spark)).repartition(5)
    broken = files.withColumn("log", F.when(F.col("name").endswith("_NA"), F.raise_error(F.lit("lost"))).otherwise(F.col("log")))
    with pytest.raises(Exception, match="lost"):
        runlogs.write_run_files(broken, str(path))
    assert not path.exists() or list(path.iterdir()) == []
