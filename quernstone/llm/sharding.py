"""Reproducible shuffling into shards: a Feistel permutation of the global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.operators.positions import positions_in_order

SEED = 41
ROUNDS = 4
# Odd multiplier and masks of the round function (32-bit words).
MULTIPLIER = 73_244_475
WORD = 0xFFFFFFFF


def half_bits(rows: int) -> int:
    """Bits of one half, so that the domain ``4 ** bits`` holds all rows and is less than 4 times as large."""
    return max(1, (max(rows - 1, 1).bit_length() + 1) // 2)


def round_keys(seed: int) -> list[int]:
    return [(seed * 2_654_435 + 40_503 * (r + 1)) & WORD for r in range(ROUNDS)]


def _round(half: np.ndarray, key: int) -> np.ndarray:
    x = (half + np.uint64(key)) & np.uint64(WORD)
    for _ in range(2):
        x = ((x ^ (x >> np.uint64(16))) * np.uint64(MULTIPLIER)) & np.uint64(WORD)
    return x ^ (x >> np.uint64(16))


def _feistel(x: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & mask
    for key in keys:
        left, right = right, left ^ (_round(right, key) & mask)
    return (left << np.uint64(bits)) | right


def permuted(numbers: np.ndarray, rows: int, seed: int = SEED) -> np.ndarray:
    """Place of each row number in the shuffle of ``rows`` rows; walks on until it lies inside."""
    bits, keys = half_bits(rows), round_keys(seed)
    out = _feistel(numbers.astype(np.uint64), bits, keys)
    while True:
        outside = np.flatnonzero(out >= rows)
        if not len(outside):
            return out.astype(np.int64)
        out[outside] = _feistel(out[outside], bits, keys)


def original(places: np.ndarray, rows: int, seed: int = SEED) -> np.ndarray:
    """Row number at each place: the inverse walk."""
    bits, keys = half_bits(rows), round_keys(seed)
    mask = np.uint64((1 << bits) - 1)

    def back(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(bits), x & mask
        for key in reversed(keys):
            left, right = right ^ (_round(left, key) & mask), left
        return (left << np.uint64(bits)) | right

    out = back(places.astype(np.uint64))
    while (outside := np.flatnonzero(out >= rows)).size:
        out[outside] = back(out[outside])
    return out.astype(np.int64)


def locate(number: int, rows: int, shards: int, seed: int = SEED) -> tuple[int, int]:
    """Shard and slot of one row number, without any table."""
    place = int(permuted(np.array([number]), rows, seed)[0])
    return place % shards, place // shards


def feistel_shards(df: DataFrame, order: list[str], shards: int = 40, seed: int = SEED) -> DataFrame:
    """``df`` with ``row_number`` (from 0), ``shard`` and ``slot`` (from 0, gapless in each shard).

    Rows are numbered in ``order`` by range partitions and their counts; the permutation turns numbers
    into places, and place ``p`` is slot ``p DIV shards`` of shard ``p % shards``, so shard sizes differ
    by one row at most. Only the last column of the plan, the permutation, runs in Python, on numbers.

    Rows that agree in all of ``order`` get neighbouring numbers in any order. Nulls come first. Fewer
    rows than shards leave shards empty, an empty table gives no rows. Columns of ``df`` with the names
    of the new ones are replaced.
    """
    if shards < 1:
        raise ValueError("there must be one shard at least")
    numbered, rows = positions_in_order(df.drop("row_number", "shard", "slot"), order, "row_number")

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), rows, seed))

    placed = numbered.withColumn("row_number", F.col("row_number") - 1).withColumn("_place", place("row_number"))
    return placed.withColumn("shard", F.expr(f"cast(_place % {shards} AS int)")).withColumn("slot", F.expr(f"_place DIV {shards}")).drop("_place")
