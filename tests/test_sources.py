"""Reading and writing through real files."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from quernstone.plans import refinery
from quernstone.sources import jsonl, runlogs, sourcetree
from tests.test_refine import ROWS, brute

LINES = [
    ('{"code":"a","docstring":"d"}', ("a", "d", False)),
    ('{"func_code_string":"b","func_documentation_string":"e"}', ("b", "e", False)),
    ('{"code":null,"func_code_string":"b","docstring":"d"}', (None, "d", False)),
    ('{"code":"x","code":"y"}', ("y", "", False)),
    ('{"docstring":"only"}', ("", "only", False)),
    ('{"code":5,"docstring":{"z":1}}', ("5", '{"z":1}', False)),
    ("{'code':'a'}", (None, None, True)),
    ('{"code":"a"', (None, None, True)),
    ('{"code":"a"} junk', (None, None, True)),
    ("", (None, None, True)),
    ("[1]", (None, None, True)),
    ("5", (None, None, True)),
    ('{"code":"a\tb"}', (None, None, True)),
]


def write_gz(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8", newline="\n") as out:
        out.write("".join(line + "\n" for line in lines))


def test_normalize_keys(spark):
    frame = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(LINES)], "i int, raw string")
    rows = jsonl.normalize_keys(frame).orderBy("i").collect()
    assert [(r.code, r.docstring, r.malformed) for r in rows] == [want for _, want in LINES]


def test_shards_keep_file_order_and_splits(spark, tmp_path):
    write_gz(f"{tmp_path}/train/a_0.jsonl.gz", ["t1", "t2", "t3"])
    write_gz(f"{tmp_path}/train/a_1.jsonl.gz", ["t4"])
    write_gz(f"{tmp_path}/valid/b_0.jsonl.gz", ["v1", "", "v2"])
    write_gz(f"{tmp_path}/valid/ignored.txt.gz", ["no"])
    rows = jsonl.read_jsonl_shards(spark, str(tmp_path)).orderBy("file", "block", "seq").collect()
    assert [(r.split, r.raw) for r in rows] == [
        ("train", "t1"), ("train", "t2"), ("train", "t3"), ("train", "t4"), ("valid", "v1"), ("valid", ""), ("valid", "v2")]
    only = jsonl.read_jsonl_shards(spark, str(tmp_path), "valid")
    assert only.count() == 3
    assert jsonl.read_jsonl_shards(spark, str(tmp_path), "test").count() == 0


def test_split_is_the_nearest_folder_below_the_root(spark, tmp_path):
    root = tmp_path / "train" / "test" / "raw data"
    write_gz(f"{root}/valid/a.jsonl.gz", ["v"])
    write_gz(f"{root}/train/deep/test/b.jsonl.gz", ["t"])
    rows = jsonl.read_jsonl_shards(spark, str(root)).collect()
    assert sorted((r.split, r.raw) for r in rows) == [("test", "t"), ("valid", "v")]
    write_gz(f"{root}/stray.jsonl.gz", ["s"])
    with pytest.raises(Exception, match="no split folder"):
        jsonl.read_jsonl_shards(spark, str(root)).collect()
    assert jsonl.read_jsonl_shards(spark, f"{tmp_path}/nowhere").count() == 0


def test_preview_of_nothing_and_by_file_name(spark, tmp_path):
    os.makedirs(f"{tmp_path}/train/empty")
    assert jsonl.preview(spark, f"{tmp_path}/train/empty").collect() == []
    write_gz(f"{tmp_path}/train/z_train_0.jsonl.gz", ['{"code":"yes"}'])
    write_gz(f"{tmp_path}/train/a_test_0.jsonl.gz", ['{"code":"no"}'])
    assert "yes" in jsonl.preview(spark, f"{tmp_path}/train").first().sample


def test_raw_shards_to_refined_shards(spark, tmp_path):
    names = ("code", "docstring"), ("func_code_string", "func_documentation_string")
    for split in ("train", "valid", "test"):
        lines = [json.dumps(dict(zip(names[i % 2], (c, d)))) for i, s, c, d in ROWS if s == split]
        write_gz(f"{tmp_path}/in/{split}/part.jsonl.gz", [*lines, "{broken"])
    audit = {r.split: r for r in refinery.refine_shards(spark, f"{tmp_path}/in", f"{tmp_path}/out").collect()}
    assert all(audit[s].malformed == 1 and audit[s].kept == sum(v == "kept" and ROWS[i - 1][1] == s for i, v in brute(ROWS).items()) for s in audit)
    kept = [i for i, v in brute(ROWS).items() if v == "kept"]
    rows = spark.read.json(f"{tmp_path}/out").collect()
    assert sorted((r.split, r.docstring) for r in rows) == sorted((ROWS[i - 1][1], ROWS[i - 1][3]) for i in kept)


def test_written_lines_are_ascii(spark, tmp_path):
    frame = spark.createDataFrame([("train", "é = 'ß'", "naïve\n text")], "split string, code string, docstring string")
    jsonl.write_refined(frame, f"{tmp_path}/out")
    [name] = [n for n in os.listdir(f"{tmp_path}/out/split=train") if n.endswith(".json.gz")]
    raw = gzip.open(f"{tmp_path}/out/split=train/{name}").read()
    assert raw.isascii() and json.loads(raw) == {"code": "é = 'ß'", "docstring": "naïve\n text"}


def test_preview_counts_broken_lines(spark, tmp_path):
    write_gz(f"{tmp_path}/x_train_1.jsonl.gz", ['{"code":" a ","docstring":"d "}', "{", '{"other":1}', '{"code":"late"}'])
    write_gz(f"{tmp_path}/a_test_0.jsonl.gz", ["{}"])
    rows = jsonl.preview(spark, str(tmp_path), 3).orderBy("sample_no").collect()
    assert [r.sample_no for r in rows] == [1, 2, 3]
    assert "(DOC): d\nINPUT LOGIC (CODE):\na\n" in rows[0].sample
    assert "JSON DECODE ERROR" in rows[1].sample
    assert "(DOC): N/A" in rows[2].sample


def test_preview_reads_one_shard_from_its_start_and_stops(spark, tmp_path):
    lines = [json.dumps({"code": f"c{i}", "docstring": "d" * 100}) for i in range(40_000)]
    for name in ("train/b_train_0", "valid/a_valid_0", "_hidden/a_train_0", "train/c_train_1"):
        write_gz(f"{tmp_path}/{name}.jsonl.gz", lines[::-1] if "b_train" in name else ["{}"])
    assert jsonl.first_shard(spark, str(tmp_path)).endswith("/train/b_train_0.jsonl.gz")
    (tmp_path / "plain.txt").write_text("\n".join(lines), encoding="utf-8")
    plan = jsonl.preview(spark, str(tmp_path), 5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "TakeOrdered" not in plan
    rows = jsonl.preview(spark, str(tmp_path), 5).collect()
    assert [r.sample_no for r in rows] == [1, 2, 3, 4, 5] and all(f"\nc{39_999 - i}\n" in r.sample for i, r in enumerate(rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        rows = jsonl.preview(spark, str(tmp_path), 3_000, "plain.txt").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.sample_no for r in rows] == list(range(1, 3_001)) and all(f"\nc{i}\n" in r.sample for i, r in enumerate(rows))


def test_metric_array(spark, tmp_path):
    rows = [{"file": "f1", "model": "m", "bleu": 0.1, "Mean Epoch (s)": 2.5, "Subset": "20"}, {"file": "f2", "model": "m"}]
    (tmp_path / "m.json").write_text(json.dumps(rows, indent=2))
    got = runlogs.read_metrics(spark, str(tmp_path / "m.json")).orderBy("file").collect()
    assert [(r.file, r.bleu, r["Mean Epoch (s)"]) for r in got] == [("f1", 0.1, "2.5"), ("f2", None, None)]


def test_source_tree_skips_ignored_folders(spark, tmp_path):
    for name in ("a.py", "pkg/b.py", "pkg/__pycache__/c.py", "venv/d.py", "pkg/venv.py", "pkg/e.txt"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"# {name} é\n", encoding="utf-8")
    rows = sourcetree.read_source_files(spark, str(tmp_path)).orderBy("path").collect()
    assert [(r.path, r.depth) for r in rows] == [("a.py", 1), ("pkg/b.py", 2), ("pkg/venv.py", 2)]
    assert rows[0].source == "# a.py é\n" and rows[0].length == len("# a.py é\n".encode())
