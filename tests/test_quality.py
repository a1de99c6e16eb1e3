"""Scores against hand-computed and brute-force values."""

import math
import random
from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import oracle
from quernstone.functions.stem import IRREGULAR, STEP_2, STEP_3, STEP_4, stem
from quernstone.operators import quality
from quernstone.plans import evaluation

PAIR = "id bigint, run string, ref array<string>, hyp array<string>"


def brute_bleu(pairs):
    match, slots = [0] * 4, [0] * 4
    for ref, hyp in pairs:
        for n in range(1, 5):
            grams = [Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) for w in (ref, hyp)]
            match[n - 1] += sum((grams[0] & grams[1]).values())
            slots[n - 1] += max(1, len(hyp) - n + 1)
    ref_len, hyp_len = sum(len(r) for r, _ in pairs), sum(len(h) for _, h in pairs)
    if not match[0]:
        return 0.0
    shortness = 1.0 if hyp_len > ref_len else math.exp(1 - ref_len / hyp_len)
    return shortness * math.exp(sum(math.log((m or 0.1) / s) for m, s in zip(match, slots)) / 4)


def brute_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = table[i - 1][j - 1] + 1 if x == y else max(table[i - 1][j], table[i][j - 1])
    return table[-1][-1]


def random_pairs(n, seed, longest=30):
    rng = random.Random(seed)
    return [[[rng.choice("abcde") for _ in range(rng.randint(0, longest))] for _ in range(2)] for _ in range(n)]


def frame(spark, pairs, run="x"):
    return spark.createDataFrame([(i, run, r, h) for i, (r, h) in enumerate(pairs)], PAIR)


@pytest.mark.parametrize("pairs", [
    [(["the", "cat", "sat", "on", "it"], ["the", "cat", "sat", "on", "it"])],
    [(["a", "b", "c"], ["a", "b"])], [(["a"], [])], [([], ["a"])], [(["a", "b"], ["c", "d"])], random_pairs(60, 3),
])
def test_bleu(spark, pairs):
    got = quality.corpus_bleu(frame(spark, pairs), ["run"]).first()
    assert got.bleu == pytest.approx(brute_bleu(pairs), abs=1e-12)
    assert quality.corpus_bleu(frame(spark, pairs)).first().bleu == pytest.approx(brute_bleu(pairs), abs=1e-12)


def test_common_length():
    for ref, hyp in random_pairs(200, 9, 90):
        assert quality._common_length(ref, hyp) == brute_lcs(ref, hyp)


def test_stems_in_sql_equal_those_of_the_function():
    draw = random.Random(4)
    suffixes = [a for a, _ in STEP_2 + STEP_3] + list(STEP_4) + ["s", "ies", "sses", "ied", "eed", "ed", "ing", "y", "e", "ll", "logi", "alli", ""]
    words = {"".join(draw.choices("abeiostyrlnz7", k=draw.randint(0, 5))) + draw.choice(suffixes) + draw.choice(["", "s", "ed", "ing", "ly"]) for _ in range(20_000)}
    words = pd.DataFrame({"w": sorted(w for w in words | set(IRREGULAR) if w)})
    with duckdb.connect() as db:
        db.register("words", words)
        got = dict(db.execute(f"WITH {oracle.stems_sql('words')} SELECT w, stem FROM stems").fetchall())
    assert got == {w: stem(w) for w in words.w}


def test_rouge(spark):
    pairs = [(["The", "Cats", "running"], ["cat", "run", "x"]), (["é"], ["é"]), ([], []), (["a-b"], ["a", "b"])]
    rows = quality.rouge_l(frame(spark, pairs)).orderBy("id").collect()
    assert [r.rougeL for r in rows] == pytest.approx([2 * 2 / 6, 0.0, 0.0, 1.0])
    plain = quality.rouge_l(frame(spark, pairs), stemmed=False).orderBy("id").collect()
    assert [r.rougeL for r in plain] == pytest.approx([0.0, 0.0, 0.0, 1.0])
    assert quality.rouge_l_mean(frame(spark, []), stemmed=False).first().rougeL == 0.0


def test_stems():
    """Outputs published for the algorithm, and the extended rules."""
    words = (
        "caresses:caress ponies:poni ties:tie cats:cat feed:feed agreed:agre plastered:plaster bled:bled motoring:motor "
        "sing:sing conflated:conflat troubled:troubl sized:size hopping:hop tanned:tan falling:fall hissing:hiss "
        "fizzed:fizz failing:fail filing:file happy:happi sky:sky relational:relat conditional:condit rational:ration "
        "valenci:valenc digitizer:digit conformabli:conform radicalli:radic differentli:differ vileli:vile "
        "analogousli:analog vietnamization:vietnam predication:predic operator:oper feudalism:feudal "
        "decisiveness:decis hopefulness:hope callousness:callous formaliti:formal sensitiviti:sensit "
        "sensibiliti:sensibl triplicate:triplic formative:form formalize:formal electriciti:electr electrical:electr "
        "hopeful:hope goodness:good revival:reviv allowance:allow inference:infer airliner:airlin "
        "adjustable:adjust defensible:defens irritant:irrit replacement:replac adjustment:adjust "
        "dependent:depend adoption:adopt communism:commun activate:activ angulariti:angular homologous:homolog "
        "effective:effect bowdlerize:bowdler probate:probat rate:rate cease:ceas controll:control roll:roll "
        "dying:die news:news flies:fli died:die enjoy:enjoy"
    )
    for word, want in (w.split(":") for w in words.split()):
        assert stem(word) == want, word


def test_losses(spark):
    tokens = spark.createDataFrame([("r", 1.0), ("r", 3.0), ("big", 100.0)], "run string, nll double")
    got = {r.run: (r.loss, r.n_tokens, r.perplexity) for r in quality.loss_perplexity(tokens, ["run"]).collect()}
    assert got["r"] == (2.0, 2, pytest.approx(math.exp(2))) and got["big"] == (100.0, 1, float("inf"))
    empty = quality.loss_perplexity(tokens.limit(0)).first()
    assert (empty.loss, empty.n_tokens, empty.perplexity) == (0.0, 0, 1.0)


def test_batch_means_ignore_padding(spark):
    tokens = spark.createDataFrame(
        [(0, 5, 1.0), (0, 6, 3.0), (0, 0, 99.0), (1, 7, 8.0)], "batch_id int, token_id int, nll double")
    assert quality.mean_of_batch_means(tokens).first().loss == 5.0


def test_unigram_losses(spark):
    rows = spark.createDataFrame([("e", ["a", "a", "z"])], "run string, w array<string>")
    train = spark.createDataFrame([("t", ["a", "a", "b"])], "run string, w array<string>")
    got = {r.word: (r.n, r.nll) for r in quality.unigram_losses(rows, train, "w", ["run"]).collect()}
    assert got == {"a": (2, pytest.approx(-math.log(3 / 6))), "z": (1, pytest.approx(-math.log(1 / 6)))}


def failing_scorer():
    def score(batch: pd.DataFrame) -> pd.DataFrame:
        if (batch["code"] == "bad").any():
            raise ValueError("no score")
        return pd.DataFrame({"prediction": batch["code"], "nll_sum": 2.0, "n_tokens": 1})
    return score


def test_failing_rows_are_reported_and_left_out(spark):
    rows = spark.createDataFrame(
        [(1, "a_transformer.pt", "adds two", "adds two"), (2, "a_transformer.pt", "bad", "x y"), (3, "b.pt", "sums up", "other words")],
        "id bigint, file string, code string, docstring string")
    predicted = quality.batch_predict(rows, failing_scorer, keep=("id", "file")).orderBy("id").collect()
    assert [(r.id, r.prediction, r.error) for r in predicted] == [
        (1, "adds two", None), (2, None, "no score"), (3, "sums up", None)]
    scorers = {"a_transformer.pt": failing_scorer, "b.pt": quality.keyword_scorer(1)}
    report = {r.file: r for r in evaluation.evaluate(rows.drop("file"), scorers).collect()}
    assert report["a_transformer.pt"].rougeL == 0.5 and report["a_transformer.pt"].model == "transformer"
    assert report["a_transformer.pt"].perplexity == pytest.approx(math.exp(2))
    assert report["b.pt"].loss == pytest.approx((7 + 2 + 10) / 10 / 6)


def test_budget_holds_for_every_run(spark):
    rows = spark.range(20).select("id", F.lit("a b").alias("code"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("docstring"))
    def counting():
        def score(batch):
            return pd.DataFrame({"prediction": batch["docstring"], "nll_sum": batch["docstring"].str[1:].astype(float), "n_tokens": 1})
        return score

    report = evaluation.evaluate(rows, {f"r{k}.pt": counting for k in range(3)}, budget=7).collect()
    assert len(report) == 3 and all(r.loss == pytest.approx(3.0) for r in report)


def tallying_scorer(folder, name):
    """Leaves a file per row it is asked for."""
    def make():
        def score(batch):
            for code in batch["code"]:
                open(f"{folder}/{name}-{code}", "x").close()
            return pd.DataFrame({"prediction": batch["docstring"], "nll_sum": 1.0, "n_tokens": 1})
        return score
    return make


def test_stored_predictions_are_not_made_again(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    rows = spark.createDataFrame([(i, f"c{i}", f"some words {i}") for i in range(30)], "id long, code string, docstring string")
    scorers = {f"{n}.pt": tallying_scorer(str(calls), n) for n in ("a", "b")}
    store = str(tmp_path / "store")
    assert len(evaluation.evaluate(rows.filter("id < 10"), {"a.pt": scorers["a.pt"]}, store=store).collect()) == 1
    assert len(list(calls.iterdir())) == 10
    first = evaluation.evaluate(rows, scorers, store=store).orderBy("file").collect()
    assert len(list(calls.iterdir())) == 60  # the scorer refuses to be asked twice
    assert evaluation.evaluate(rows, scorers, store=store).orderBy("file").collect() == first and len(first) == 2
    assert evaluation.predict_missing(rows, scorers, store).filter("error IS NOT NULL").count() == 0
    few = evaluation.predict_missing(rows.filter("id >= 25"), scorers, store)
    assert sorted((r.id, r.file) for r in few.collect()) == [(i, f) for i in range(25, 30) for f in ("a.pt", "b.pt")]


def test_all_runs_read_the_rows_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([(1, "a", "b")], "id long, code string, docstring string").write.parquet(path)
    predicted = quality.predict_runs(spark.read.parquet(path), {f"{k}.pt": quality.keyword_scorer(k) for k in range(1, 6)})
    assert predicted.count() == 5 and predicted._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
