"""The dealt operators as registered queries, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm import (
    exact_copies, language, line_windows, minhash, mixing, near_vectors, packing, personal_data, phrases, sharding, url_filter, vector_search, whitening,
)

Query = Callable[[SparkSession, str], DataFrame]

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
SHARDS = 40
ASKING = 100
PER_SEQUENCE = 64


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_near_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors.near_vectors(_table(spark, sf, "embeddings"))


def op2_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, sf, "documents").select("doc_id", "text", "source"))
    return mixed.select("_row.doc_id", "size", "source_size", "target", "taken")


def op3_pack_documents(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf, "documents"), documents=PER_SEQUENCE, with_ids=False)


def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    found = language.identify(_table(spark, sf, "documents").select("doc_id", "text", "lang", "source"))
    return found.select("_row.doc_id", "language", F.round("confidence", 6).alias("confidence"), "accepted")


def language_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The same over web pages, with the markup's language, the host and its suffix."""
    pages = _table(spark, sf, "pages").select(
        "page_id",
        F.regexp_replace(F.regexp_replace("html", r"(?s)<(script|style)\b.*?</\1>|<!--.*?-->", " "), "<[^>]*>", " ").alias("text"),
        F.regexp_extract("html", r"""<html[^>]*\blang=["']?([A-Za-z-]+)""", 1).alias("lang"),
        url_filter.host_of(F.col("url")).alias("host"),
    ).withColumn("lang", F.nullif("lang", F.lit("")))
    found = language.identify(pages, language.Columns(id="page_id", host="host"))
    return found.select("_row.page_id", "language", F.round("confidence", 6).alias("confidence"), "accepted")


def op5_vector_search(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "embeddings")
    return vector_search.top_k_inner(rows, rows.filter(F.col("vec_id") % ASKING == 0))


def op6_feistel_shards(spark: SparkSession, sf: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    sized = _table(spark, sf, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = sharding.feistel_shards(sized, ["doc_id", "text_crc32", "size"], SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_line_windows(spark: SparkSession, sf: str) -> DataFrame:
    cut = line_windows.drop_repeated_lines(_table(spark, sf, "documents").select("doc_id", "text"))
    return cut.select("_row.doc_id", "n_lines", "n_removed", "_row.text")


def op8_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_classes(_table(spark, sf, "documents"), percent=85)


def op9_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf, "pages").select("page_id", "url"), RULES)


def op10_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return personal_data.digest(personal_data.find_personal_data(_table(spark, sf, "documents")))


def op11_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_copies.exact_classes(_table(spark, sf, "documents"), digests=True)


def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf, "documents"))


def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf, "embeddings"))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


def queries() -> dict[str, Query]:
    return {
        run.__name__: run
        for run in (
            op1_near_vectors, op2_mix_sources, op3_pack_documents, op4_language_id, op5_vector_search, op6_feistel_shards,
            op7_line_windows, op8_minhash, op9_url_filter, op10_personal_data,
            op11_exact_dedup, op12_collocations, op13_whitening, language_pages, pipeline,
        )
    }


def oracle_sql() -> dict[str, str]:
    from quernstone.llm import statements

    return statements.build()
