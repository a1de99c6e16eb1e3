"""Encoding with a learned vocabulary, decoding, padded batches."""

from __future__ import annotations

import heapq
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from quernstone.functions import tokens as K

_CACHE_LIMIT = 500_000


def _merge_word(word: str, letter_ids: dict[str, int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply the best-ranked merge that fits, leftmost first, until none does; n log n in the word's length.

    Pieces form a linked list; a heap holds the pairs that can merge. A pair that has changed since it
    was put there is passed over.
    """
    ids = [letter_ids.get(c, K.UNK) for c in word]
    after, before = [*range(1, len(ids)), -1], list(range(-1, len(ids) - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(at: int) -> None:
        if at >= 0 and after[at] >= 0:
            hit = merges.get((ids[at], ids[after[at]]))
            if hit:
                heapq.heappush(heap, (hit[0], at, ids[at], ids[after[at]]))

    for at in range(len(ids)):
        offer(at)
    while heap:
        _, at, left, right = heapq.heappop(heap)
        follower = after[at]
        if ids[at] != left or follower < 0 or ids[follower] != right:
            continue
        ids[at], ids[follower], after[at] = merges[left, right][1], -1, after[follower]
        if after[at] >= 0:
            before[after[at]] = at
        offer(before[at])
        offer(at)
    return [i for i in ids if i >= 0]


def bpe_encoder(vocab: DataFrame, merges: DataFrame) -> Callable[[Column], Column]:
    """Column function from text to ids.

    Splitting and the byte alphabet are native expressions; the Arrow function only maps pre-tokens
    to ids and remembers them per worker, so a frequent one is merged once. No row leaves its task. The
    merges are a model of the size that was asked for in training, and travel as one.
    """
    letter_ids = {r["token"]: r["id"] for r in vocab.filter(F.length("token") == 1).collect()}
    by_pair = {(r["left"], r["right"]): (r["rank"], r["new"]) for r in merges.collect()}
    shared = vocab.sparkSession.sparkContext.broadcast((letter_ids, by_pair))
    cache: dict[str, list[int]] = {}

    @pandas_udf("array<int>")
    def ids_of(pretokens: pd.Series) -> pd.Series:
        letters, pairs = shared.value
        out = []
        for words in pretokens:
            ids: list[int] = []
            for word in words:
                known = cache.get(word)
                if known is None:
                    if len(cache) >= _CACHE_LIMIT:
                        cache.clear()
                    known = cache[word] = _merge_word(word, letters, pairs)
                ids.extend(known)
            out.append(ids)
        return pd.Series(out, dtype=object)

    return lambda text: ids_of(F.transform(K.pretokenize(text), K.byte_level))


def encode_pairs(
    refined: DataFrame,
    encoder: Callable[[Column], Column],
    max_code: int = K.MAX_CODE_IDS,
    max_doc: int = K.MAX_DOC_IDS,
) -> DataFrame:
    """Wrapped id arrays of both sides; rows with an empty side are left out."""
    full = refined.filter((F.col("code") != "") & (F.col("docstring") != ""))
    coded = full.select("id", "split", encoder(F.col("code")).alias("c"), encoder(F.col("docstring")).alias("d"))
    return coded.select(
        "id", "split", K.wrap_ids(F.col("c"), max_code).alias("code_ids"), K.wrap_ids(F.col("d"), max_doc).alias("doc_ids")
    )


def pad_batch(batched: DataFrame, columns: tuple[str, ...], batch: str = "batch_id") -> DataFrame:
    """Pad id arrays with ``PAD`` to the longest of their batch."""
    longest = {c: F.max(F.size(c)).over(W.partitionBy(batch)) for c in columns}
    sized = batched.withColumns({f"_max_{c}": m for c, m in longest.items()})
    padded = {
        c: F.concat(F.col(c), F.array_repeat(F.lit(K.PAD), F.col(f"_max_{c}") - F.size(c))) for c in columns
    }
    return sized.withColumns(padded).drop(*[f"_max_{c}" for c in columns])


def padding_economy(batched: DataFrame, caps: dict[str, int], batch: str = "batch_id") -> DataFrame:
    """Slots spent with per-batch padding and with padding to a fixed cap, per id column."""
    per_batch = batched.groupBy(batch).agg(
        F.count("*").alias("_n"), *[F.max(F.size(c)).alias(c) for c in caps]
    )
    rows = per_batch.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("side"), F.col(c).alias("longest"), F.lit(cap).alias("cap")) for c, cap in caps.items()
    ])).alias("s"))
    return rows.groupBy("s.side").agg(
        F.sum(F.col("_n") * F.col("s.longest")).alias("batch_slots"),
        F.sum(F.col("_n") * F.col("s.cap")).alias("fixed_slots"),
    )


def decode(rows: DataFrame, vocab: DataFrame, ids: str = "ids", out: str = "text", key: str = "id") -> DataFrame:
    """Pieces of an id array joined by spaces, control tokens skipped; word-start marks stay.

    Ids meet their tokens in a join, so a vocabulary may have any size and any gaps; ids it does not
    hold are skipped. ``key`` tells rows apart.
    """
    body = F.filter(F.col(ids), lambda i: i >= len(K.SPECIAL_TOKENS))
    places = rows.select(key, F.posexplode(body).alias("_at", "_id"))
    known = places.join(vocab.select(F.col("id").alias("_id"), F.col("token").alias("_token")), "_id")
    texts = known.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list(F.struct("_at", "_token")))["_token"], " ").alias("_text"))
    return rows.join(texts, key, "left").withColumn(out, F.coalesce("_text", F.lit(""))).drop("_text")
