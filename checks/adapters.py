"""Shape the given tables into the frames the operators work on (whole tables, whole texts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import runs as R
from quernstone.operators.positions import positions_by_id
from quernstone.session import stored


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and texts, dealt out by id: the given tables are single files that one task would read."""
    return table(spark, folder, "documents").select("doc_id", "text").repartition("doc_id")


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """First line as the docstring, the rest as code; ids ending in 8 and 9 are held out."""
    return documents(spark, folder).selectExpr(
        "doc_id AS id",
        "CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'valid' ELSE 'test' END AS split",
        "split_part(text, chr(10), 1) AS docstring",
        "CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS code",
    )


def noisy_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with a URL, a tag line and a doctest line after their first line, and a second paragraph."""
    return documents(spark, folder).selectExpr(
        "doc_id AS id",
        """split_part(text, chr(10), 1) || ' see http://x.example/' || cast(doc_id AS string) || ' now' || chr(10)
           || ':param p: thing' || chr(10) || '>>> run(' || cast(doc_id AS string) || ')' || chr(10)
           || CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END || chr(10) || chr(10)
           || 'Second paragraph' AS docstring""",
    )


# SQL that both engines read: a module that one file in six imports inside its body, and the file's one symbol.
MODULE_SQL = """CASE l_partkey % 6 WHEN 0 THEN 'json' WHEN 1 THEN 'numpy' WHEN 2 THEN 'zlib' WHEN 3 THEN 'Requests'
  WHEN 4 THEN 'wsgiref' ELSE 'yaml' END"""
NAME_SQL = "CASE l_linenumber % 3 WHEN 0 THEN 'f_' WHEN 1 THEN 'g_' ELSE 'C_' END || cast(l_orderkey AS string)"
SOURCE_SQL = f"""'import os' || chr(10) || 'from ' || lower(l_returnflag) || '_pkg.mod import x' || chr(10)
  || 'from .sib import y' || chr(10)
  || CASE l_linenumber % 3 WHEN 0 THEN 'def ' WHEN 1 THEN 'async def ' ELSE 'class ' END || {NAME_SQL}
  || CASE l_linenumber % 3 WHEN 0 THEN '(a, b, *args, k=1, **kw):' WHEN 1 THEN '(p, /, q):' ELSE ':' END || chr(10)
  || '    ' || repeat(chr(34), 3) || 'Doc ' || l_linestatus || '.' || repeat(chr(34), 3) || chr(10)
  || '    import ' || {MODULE_SQL} || '.part' || chr(10)
  || '    s = ' || chr(34) || 'a#b' || chr(34) || '  # note ' || cast(l_partkey AS string) || chr(10)
  || '   ' || chr(10)
  || '    return s + ' || chr(39) || '#' || cast(l_suppkey AS string) || chr(39) || chr(10)"""
PATH_SQL = """'src/m' || cast(l_orderkey % 50 AS string) || '/f' || cast(l_orderkey AS string) || '_'
  || cast(l_linenumber AS string) || '.py'"""


FILES_PER_TASK = 50_000
TASKS_PER_CORE = 4
FEWEST_FILES = 1_000


def file_tasks(files: int, cores: int) -> int:
    """Tasks that parse ``files``: several a core, so that none is left for a last round of long ones."""
    return max(1, -(-files // FILES_PER_TASK), min(TASKS_PER_CORE * cores, -(-files // FEWEST_FILES)))


def sources(spark: SparkSession, folder: str) -> DataFrame:
    """One small Python file per line item: functions, coroutines and classes, with nested imports.

    Line items are narrow and files slow to parse, so tasks go by the number of rows (read from the footers);
    by bytes, adaptive execution would leave a few tasks of millions of files each.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"
    )
    tasks = file_tasks(lines.count(), spark.sparkContext.defaultParallelism)
    return lines.repartition(tasks, "l_orderkey", "l_linenumber", "l_partkey").selectExpr(
        "l_orderkey * 10 + l_linenumber AS id", f"{PATH_SQL} AS path", f"{SOURCE_SQL} AS source"
    )


def epochs(spark: SparkSession, folder: str) -> DataFrame:
    """Each user as a training run, each event as an epoch in order of arrival."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    return positions_by_id(events, "event_id", group=["user_id"], name="epoch").select(
        F.col("user_id").alias("run_id"),
        F.col("epoch").cast("int").alias("epoch"),
        F.col("value").alias("val_loss"),
        F.round(F.col("value") * 0.9, 4).alias("train_loss"),
        (10 + F.col("event_id") % 50).cast("double").alias("seconds"),
        F.round(F.lit(0.01) / F.col("epoch"), 6).alias("lr"),
    )


RUN_FIELDS = (
    "CASE run_id % 3 WHEN 0 THEN 'transformer' WHEN 1 THEN 'lstm_dotproduct' ELSE 'lstm_bahdanau' END",
    """CASE cast(floor(run_id / 3) AS int) % 4 WHEN 0 THEN 20000 WHEN 1 THEN 50000 WHEN 2 THEN 70000 ELSE 0 END""",
)


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """One row per run with its file name and summary figures."""
    per_run = (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").alias("run_id"))
        .agg(
            F.min("ts").alias("started"),
            F.count("*").alias("n_epochs"),
            F.round(F.min("value"), 6).alias("min_val"),
            F.round(F.min("value") / 1000, 6).alias("bleu"),
            F.round(F.avg("value") / 1000, 6).alias("rougeL"),
            F.sum(10 + F.col("event_id") % 50).cast("double").alias("total_seconds"),
        )
    )
    named = per_run.selectExpr("*", f"{RUN_FIELDS[0]} AS model", f"{RUN_FIELDS[1]} AS subset_size")
    return named.withColumn(
        "file",
        F.format_string("20240101_0000_%s_sub%d_u%d.pt", "model", "subset_size", "run_id"),
    )


LOG_PART = 1000
LOG_TITLE = r"^RUN (\d+) PART (\d+)"


def log_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Log texts per run, in files of at most ``LOG_PART`` epoch lines.

    A first line names run and part. The timers and the metric block stand in the first file. Every
    tenth run has no metric block and every 25th no epoch lines.
    """
    line = R.render_epoch_line(*[F.col(c) for c in ("epoch", "train_loss", "val_loss", "lr", "seconds")])
    bodies = (
        epochs(spark, folder)
        .filter("run_id % 25 <> 0")
        .select("run_id", "epoch", line.alias("line"), F.floor((F.col("epoch") - 1) / LOG_PART).alias("part"))
        .groupBy("run_id", "part")
        .agg(F.sort_array(F.collect_list(F.struct("epoch", "line"))).alias("lines"))
        .select("run_id", "part", F.array_join("lines.line", "\n").alias("body"), F.lit("").alias("head"))
    )
    timers = F.concat_ws(
        "\n",
        R.render_timer_line(F.lit("model_training"), F.col("total_seconds")),
        R.render_timer_line(F.lit("evaluation_fast"), F.col("n_epochs").cast("double")),
    )
    metrics = F.format_string(
        '"file": "%s",\n"bleu": %.6f,\n"rougeL": %.6f,\n', "file", "bleu", "rougeL"
    )
    heads = runs(spark, folder).select(
        "run_id",
        F.lit(0).cast("bigint").alias("part"),
        F.lit("").alias("body"),
        F.concat(timers, F.lit("\n"), F.when(F.expr("run_id % 10 <> 0"), metrics).otherwise("")).alias("head"),
    )
    whole = bodies.unionByName(heads).groupBy("run_id", "part").agg(
        F.concat(F.max("head"), F.max("body"), F.lit("\n")).alias("content")
    )
    title = F.format_string("RUN %d PART %d\n", "run_id", "part")
    path = F.format_string("logs/20240101_000000_run%d_part%d.log", "run_id", "part")
    return whole.select("run_id", F.col("part").cast("int").alias("part"), path.alias("path"), F.concat(title, "content").alias("content"))


def metric_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One metric row per run; the mean epoch is a text and unreadable for every seventh run."""
    return runs(spark, folder).select(
        "run_id", "file", "model", "subset_size", "bleu", "rougeL",
        F.col("min_val").alias("loss"),
        F.round(R.perplexity(F.col("min_val")), 6).alias("perplexity"),
        F.col("subset_size").cast("string").alias("Subset"),
        F.when(F.expr("run_id % 7 = 0"), "n/a")
        .otherwise(F.format_string("%.2f", F.round(F.col("total_seconds") / F.col("n_epochs"), 2)))
        .alias("Mean Epoch (s)"),
    )


def json_text(column: str) -> str:
    """SQL that writes a text as a JSON string; the same expression runs in both engines."""
    steps = [("chr(92)", "chr(92) || chr(92)"), ("chr(34)", "chr(92) || chr(34)"), ("chr(10)", "chr(92) || 'n'"),
             ("chr(13)", "chr(92) || 'r'"), ("chr(9)", "chr(92) || 't'")]
    body = column
    for old, new in steps:
        body = f"replace({body}, {old}, {new})"
    return f"chr(34) || {body} || chr(34)"


def dirty_line_sql() -> str:
    """A raw JSON line per pair: both layouts, and six ways to be broken or incomplete."""
    code, doc, q = json_text("code"), json_text("docstring"), "chr(34)"

    def key(name: str) -> str:
        return f"{q} || '{name}' || {q} || ':'"

    refined = f"{key('code')} || {code} || ',' || {key('docstring')} || {doc}"
    return f"""CASE id % 8
      WHEN 0 THEN '{{' || {key('func_code_string')} || {code} || ',' || {key('func_documentation_string')} || {doc} || '}}'
      WHEN 1 THEN '{{' || {refined} || '}}'
      WHEN 2 THEN '{{' || chr(39) || 'code' || chr(39) || ':' || chr(39) || 'x' || chr(39) || '}}'
      WHEN 3 THEN '{{' || {key('code')} || {code}
      WHEN 4 THEN '{{' || {key('code')} || 'null,' || {key('func_code_string')} || {code} || ',' || {key('docstring')} || {doc} || '}}'
      WHEN 5 THEN ''
      WHEN 6 THEN '[1]'
      ELSE '{{' || {refined} || ',' || {key('repo')} || {q} || 'r' || {q} || ',' || {key('stars')} || '3}}' END"""


SHARD_ROWS = 1000


def write_shards(frame: DataFrame, path: str) -> None:
    """``split, id, raw`` as gzip text, a file per split and ``SHARD_ROWS`` ids, lines in id order."""
    shard = F.format_string("%06d", F.floor(F.col("id") / SHARD_ROWS))
    (
        frame.withColumn("shard", shard)
        .repartition("split", "shard")
        .sortWithinPartitions("split", "shard", "id")
        .select("split", "shard", "raw")
        .write.partitionBy("split", "shard").option("compression", "gzip").text(path)
    )


def dirty_lines(spark: SparkSession, folder: str) -> DataFrame:
    return pairs(spark, folder).selectExpr("split", "id", f"{dirty_line_sql()} AS raw")


def clean_lines(spark: SparkSession, folder: str) -> DataFrame:
    line = f"'{{' || {json_text('\'code\'')} || ':' || {json_text('code')} || ',' || {json_text('\'docstring\'')} || ':' || {json_text('docstring')} || '}}'"
    return pairs(spark, folder).selectExpr("split", "id", f"{line} AS raw")


def scored_pairs(refined: DataFrame) -> DataFrame:
    """References and a rule-made hypothesis per row: the docstring without its short words."""
    from quernstone.functions import text as T

    ref = T.split_words(F.col("docstring"))
    return refined.select(
        "id", F.col("split").alias("run"), ref.alias("ref"), F.filter(ref, lambda w: F.length(w) > 2).alias("hyp")
    )


def word_table(refined: DataFrame) -> DataFrame:
    """Word ids from 4 on over the training pairs: commonest first, equals by hash."""
    from quernstone.functions import text as T
    from quernstone.operators.positions import positions_in_order

    train = refined.filter(F.col("split") == "train")
    words = F.explode(F.concat(T.split_words(F.col("docstring")), T.split_words(F.col("code"))))
    counts = train.select(words.alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    hashed = counts.select("token", (-F.col("n")).alias("c"), F.md5("token").alias("h"))
    ranked, _ = positions_in_order(hashed, ["c", "h"])
    return stored(ranked.select((F.col("pos") + 3).cast("int").alias("id"), "token"), "words")


def word_ids(refined: DataFrame, table: DataFrame) -> DataFrame:
    """``id, split, code_ids, doc_ids``: both sides as arrays of word ids; words unseen in training are 3.

    The table is a stored one, so a word that fills a third of all text is split over tasks by the join.
    """
    from quernstone.functions import text as T

    sides = F.array(*[
        F.struct(F.lit(side).alias("side"), T.split_words(F.col(column)).alias("words")) for side, column in (("c", "code"), ("d", "docstring"))
    ])
    words = refined.select("id", "split", F.explode(sides).alias("s")).select("id", "split", "s.side", F.posexplode("s.words").alias("at", "token"))
    coded = words.join(table.withColumnRenamed("id", "token_id"), "token", "left").withColumn("token_id", F.coalesce("token_id", F.lit(3)))

    def ids(side: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("side") == side, F.struct("at", "token_id"))))["token_id"]

    return coded.groupBy("id", "split").agg(ids("c").alias("code_ids"), ids("d").alias("doc_ids"))
