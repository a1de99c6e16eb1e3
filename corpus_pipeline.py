"""From raw documents to packed sequences: five stages, each a DataFrame in and a DataFrame out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm import language, line_windows, minhash, mixing, packing
from quernstone.llm.common import stored
from quernstone.session import remove, scratch_path, ship_packages, step_folder

NEAR_PERCENT = 80
PER_SEQUENCE = 64


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the evidence settles; others go."""
    ship_packages(spark)
    return language.identify(docs).filter("accepted").select("_row.*")


def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages keep their first place; a document of which nothing is left goes."""
    ship_packages(spark)
    cut = line_windows.drop_repeated_lines(docs).filter("n_removed = 0 OR n_removed < n_lines").select("_row", "n_removed")
    kept = {c: F.col(f"_row.`{c}`") for c in docs.columns}
    if "n_chars" in kept:
        changed = F.when(F.col("n_removed") > 0, F.length("_row.text")).otherwise(kept["n_chars"])
        kept["n_chars"] = changed.cast(docs.schema["n_chars"].dataType)
    return cut.select(*[value.alias(c) for c, value in kept.items()])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies stays."""
    ship_packages(spark)
    gone = minhash.near_classes(docs, percent=NEAR_PERCENT).filter("NOT kept").select("doc_id").distinct()
    return docs.join(stored(gone, "near-copies"), "doc_id", "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix of sources takes."""
    ship_packages(spark)
    taken = mixing.mix_sources(docs).filter("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, one row per piece with its ids and its place."""
    ship_packages(spark)
    return packing.pack_documents(docs, documents=PER_SEQUENCE)


STAGES = [
    ("language ID", known_languages),
    ("line dedup", lines_once),
    ("MinHash near-dedup", one_of_each),
    ("mixing", mixed),
    ("packing", packed),
]

# Language ID, hashing and tokenisation have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; a stage's own tables go once it is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage")
        with step_folder(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
