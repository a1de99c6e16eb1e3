"""What the physical plans must and must not contain, and how skewed groups are spread."""

import os

import pytest
from pyspark.sql import functions as F

from checks import catalog
from quernstone import session
from quernstone.operators import encoding, positions, quality, refine, runs, sampling

SMALL = "/root/testdata/sf0.001"

NATIVE = [
    "clean_docstring", "clean_code", "word_count", "fingerprint", "reject_reason", "dedup_train_keep_first",
    "cross_split_anti", "leakage_pairs", "refine", "refinery_audit", "loss_perplexity", "new_best_flag",
    "parse_epochs", "run_summary", "metric_matrix", "assign_batches", "pad_batch", "decode", "pretoken_counts",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_worker_and_no_cross_join(spark, name):
    text = plan(catalog.queries()[name](spark, SMALL))
    for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize("name", [
    "refine", "refinery_audit", "corpus_bleu", "dedup_train_keep_first", "new_best_flag", "pretoken_counts", "assign_batches",
    "assign_batches_in_order", "pad_batch", "decode", "encode",
])
def test_nothing_is_gathered_in_one_task(spark, name):
    assert "SinglePartition" not in plan(catalog.queries()[name](spark, SMALL))


def test_scan_reads_only_what_is_used(spark):
    text = plan(refine.refinery_audit(refine.judge_pairs(catalog.A.pairs(spark, SMALL))))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_ranks_are_cut_before_the_shuffle(spark):
    rows = spark.range(100).withColumn("fp", F.col("id") % 3).withColumn("split", F.col("id") % 2)
    for frame in (refine.dedup_keep_first(rows), sampling.sample_n_per_split(rows, 3)):
        text = plan(frame)
        assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_only_sums_travel_for_bleu(spark):
    pairs = spark.range(10).select("id", F.lit("r").alias("run"), F.array(F.lit("a")).alias("ref"), F.array(F.lit("a")).alias("hyp"))
    text = plan(quality.corpus_bleu(pairs, ["run"]))
    assert text.count("Exchange") == 1 and "partial_sum" in text


def final_plan(df):
    df.collect()
    return plan(df)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skewed(spark):
    """Half of the gated rows share one fingerprint; no broadcasts, small thresholds."""
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    fp = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.md5(F.col("id").cast("string")))
    split = F.when(F.col("id") % 10 < 8, "train").otherwise("test")
    rows = spark.range(0, 120_000, 1, 8).select("id", split.alias("split"), F.md5(F.col("id").cast("string")).alias("code"), F.lit("d").alias("docstring"), fp.alias("fp"))
    yield session.stored(rows, "skewed")
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_fingerprint_is_split(skewed):
    for frame in (refine.refine_gated(skewed), refine.kept_ids(skewed.select("id", "split", "fp")), refine.leakage_pairs(skewed), refine.cross_split_anti(skewed)):
        assert "skew=true" in final_plan(frame)


def test_narrow_decision_keeps_the_same_rows(skewed):
    kept = refine.kept_ids(skewed.select("id", "split", "fp"))
    assert sorted(r.id for r in kept.collect()) == sorted(r.id for r in refine.refine_gated(skewed).select("id").collect())


def test_filters_do_not_repeat_the_cleaning(spark):
    text = plan(refine.gate_pairs(catalog.A.pairs(spark, SMALL)))
    filters = [line for line in text.split("\n") if "Filter" in line]
    assert filters and not any("regexp_replace" in line for line in filters)


def test_hot_run_is_numbered_and_flagged_in_blocks(spark):
    """One run with a third of all rows: no window group exceeds the block width."""
    rows = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("run_id"),
        ((F.col("id") * 7919) % 1000).cast("double").alias("val_loss"))
    placed = positions.positions_by_id(rows, "id", ["run_id"], "epoch", width=100)
    hot = placed.filter("run_id = 0")
    assert [r.epoch for r in hot.orderBy("id").collect()] == list(range(1, 3001))
    flagged = runs.new_best_flag(placed, width=100).filter("run_id = 0").orderBy("epoch").collect()
    low = float("inf")
    for r in flagged:
        assert r.new_best == (r.val_loss < low)
        low = min(low, r.val_loss)
    text = plan(runs.new_best_flag(placed, width=100))
    assert text.count("_block") > 0 and "run_id#" in text


def test_hot_word_is_counted_before_it_moves(spark):
    rows = spark.range(3000).select("id", F.lit("r").alias("run"), F.array(F.lit("the"), F.col("id").cast("string")).alias("w"))
    losses = quality.unigram_losses(rows, rows, "w", ["run"])
    assert losses.count() == 3001
    assert losses.filter("word = 'the'").first().n == 3000
    assert "partial_count" in plan(losses)


def test_decoding_joins_on_the_id(spark):
    table = spark.createDataFrame([(10, "a"), (11, "b"), (1_000_001, "far"), (1, "control")], "id int, token string")
    rows = spark.createDataFrame([(1, [1, 10, 11, 1_000_001, 77, 2]), (2, []), (3, None), (4, [77])], "id long, ids array<int>")
    assert {r.id: r.text for r in encoding.decode(rows, table).collect()} == {1: "a b far", 2: "", 3: "", 4: ""}


def test_scratch_must_be_shared_on_a_cluster(spark, monkeypatch):
    assert session.is_local("local") and session.is_local("local[8]")
    assert not session.is_local("local-cluster[2,1,1024]") and not session.is_local("spark://host:7077") and not session.is_local("yarn")

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster())


def test_a_step_leaves_no_scratch_table(spark):
    out = session.scratch_path(spark, "out")
    with session.step_folder(spark) as folder:
        inner = session.stored(spark.range(10), "inner")
        assert all(folder in name for name in inner.inputFiles())
        with pytest.raises(KeyError), session.step_folder(spark) as deeper:
            session.stored(spark.range(3), "deeper")
            raise KeyError
        assert inner.count() == 10 and not os.path.exists(deeper.removeprefix("file:"))
        inner.write.parquet(out)
    assert not os.path.exists(folder.removeprefix("file:")) and spark.read.parquet(out).count() == 10
    assert folder not in session.scratch_path(spark, "later")
