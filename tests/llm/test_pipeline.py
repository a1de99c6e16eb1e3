"""The registered queries and the stages at the smallest scale."""

import inspect
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import compare
from quernstone.llm import catalog
from quernstone.session import shared_folder
from tests.llm.test_texts import plain_lines, plain_set

SMALL = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - {"pipeline"}))
def test_query(spark, name):
    result = compare(spark, name, entry.queries()[name], SQL.get(name), SMALL)
    assert result["ok"] and "differ" not in result["note"], result


def test_all_operators_are_registered():
    names = set(entry.queries())
    assert {n for k in range(1, 14) for n in names if n.startswith(f"op{k}_")} >= set(catalog.queries()) - {"language_pages", "pipeline"}
    assert "pipeline" in names and set(SQL) <= names and corpus_pipeline.ORACLE_SQL is None


def test_stages_take_and_return_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    before = {r.doc_id: r for r in docs.collect()}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        out = corpus_pipeline.stored(stage(spark, docs, SMALL), "test-stage")
        rows = out.collect()
        if name == "language ID":
            assert {r.doc_id for r in rows} == set(before)  # every document has a clear language
        elif name == "line dedup":
            want = {i: (n, gone, text) for i, n, gone, text in plain_lines([(r.doc_id, r.text) for r in docs.collect()])}
            kept = {i for i, (n, gone, _) in want.items() if not gone or gone < n}
            assert {r.doc_id for r in rows} == kept
            assert all(r.text == want[r.doc_id][2] and r.n_chars == len(r.text) for r in rows)
        elif name == "MinHash near-dedup":
            sets = {r.doc_id: plain_set(r.text) for r in rows}
            ids = sorted(sets)
            near = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
            assert near == [] and {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}
        elif name == "mixing":
            assert set(r.doc_id for r in rows) <= {r.doc_id for r in docs.collect()}
        if at < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            docs = out
        else:
            assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
            assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}


def test_run_leaves_the_last_stage_alone(spark):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    rows = corpus_pipeline.run(spark, SMALL)
    left = sorted(p.name.rpartition("-")[0] for p in set(folder.iterdir()) - before)
    assert left.count("stage") == 1 and set(left) <= {"stage", "pieces", "places"} and rows.count() > 0


def test_line_stage_with_clashing_and_absent_columns(spark):
    passage = "first line\nsecond line\nthird line"
    rows = [(1, f"{passage}\nown", "a", 7.0), (2, f"more\n{passage}", "b", None), (3, None, None, 1.0)]
    names = {"n_removed": "string", "n_lines": "double"}
    clash = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *[f"{k} {v}" for k, v in names.items()]]))
    got = corpus_pipeline.lines_once(spark, clash, SMALL)
    assert got.columns == clash.columns
    assert sorted(map(tuple, got.collect()), key=str) == [rows[0], (2, "more", "b", None), rows[2]]
    plain = clash.select("doc_id", "text").withColumn("n_chars", F.lit(5))
    assert sorted((r.doc_id, r.n_chars) for r in corpus_pipeline.lines_once(spark, plain, SMALL).collect()) == [(1, 5), (2, 4), (3, 5)]
