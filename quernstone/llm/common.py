"""Shared pieces: tables written between steps, and runs of sorted rows inside a task."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quernstone.session import scratch_path

CHUNK_BYTES = 1 << 20
BATCH_BYTES = "8m"
# Bits of a map of marks: so many per key, and at most.
KEY_BITS, MOST_BITS, MAP_BITS = 32, 1 << 27, 1 << 15
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage, so a lost executor costs a read and not the steps before; joins between two
    stored tables are plain exchanges on both sides, which adaptive execution can split when a key is hot.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_with(df: DataFrame, label: str, options: dict[str, str] | None = None, **figures: Column) -> tuple[DataFrame, dict]:
    """:func:`stored`, and aggregates over the rows that come with the writing itself."""
    seen = Observation()
    out = stored(df.observe(seen, *[c.alias(name) for name, c in figures.items()]), label, **(options or {}))
    return out, seen.get


def apart(df: DataFrame, *keys: str) -> DataFrame:
    """``df``, an aggregate by ``keys``, dealt out once more by a hash of them.

    A join on ``keys`` then needs an exchange on either side, as with stored tables, and adaptive
    execution can split the other side where a key is hot; it leaves a bare aggregate's key whole.
    """
    return df.repartition(F.xxhash64(*keys))


def forget(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stored`, once nothing reads it any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def give_back() -> None:
    """Return what this worker no longer uses to the system; an idle worker otherwise keeps its peak."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def frugal(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on the batches of a task, and :func:`give_back` behind it."""

    def task(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return task


def lean_batches(spark: SparkSession) -> None:
    """Let batches for Python workers hold 8 MB at most, unless the session names a size.

    Whole texts make wide rows; the default of 64 MB is held several times over by each running task.
    """
    name, unset = "spark.sql.execution.arrow.maxBytesPerBatch", "64m"
    if spark.conf.get(name, unset) == unset:
        spark.conf.set(name, BATCH_BYTES)


class Marks:
    """Which keys are in a set: one bit per key in a map of bounded size. None of the set is missed; others may pass."""

    def __init__(self, bits: int, maps: dict[int, bytes]):
        self.bits = bits
        self.data = np.zeros(bits // 8, dtype=np.uint8)
        for number, bitmap in maps.items():
            self.data[(number - 1) * MAP_BITS // 8 :][: MAP_BITS // 8] = np.frombuffer(bitmap, dtype=np.uint8)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = keys & np.uint64(self.bits - 1)
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def marks_of(keys: DataFrame, count: int) -> Marks:
    """Marks of the ``count`` values of a column ``key``, built as bitmaps on the cluster.

    The map has ``KEY_BITS`` bits per key and ``MOST_BITS`` at most, 16 MB; with more keys than that it
    lets more others pass.
    """
    bits = MAP_BITS
    while bits < min(KEY_BITS * count, MOST_BITS):
        bits *= 2
    at = F.col("key").bitwiseAND(F.lit(bits - 1)) + 1
    maps = keys.groupBy(F.bitmap_bucket_number(at).alias("number")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    return Marks(bits, {r["number"]: bytes(r["bits"]) for r in maps.collect()})


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit integers (finaliser with full avalanche); one-to-one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and their inverses."""
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for at, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[at] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice of a byte array, the same wherever the slice lies."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64, out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def key_runs(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """One frame for each run of equal ``keys`` in batches of sorted rows; holds one run at a time."""
    held: list[pd.DataFrame] = []
    last: tuple | None = None

    def taken() -> pd.DataFrame:
        return held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)

    for frame in batches:
        if frame.empty:
            continue
        values = [frame[k].to_numpy() for k in keys]
        changed = np.zeros(len(frame), dtype=bool)
        for v in values:
            changed[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(changed).tolist(), len(frame)]
        if held and tuple(v[0] for v in values) != last:
            yield taken()
            held.clear()
        for start, end in zip(cuts, cuts[1:]):
            if start and held:
                yield taken()
                held.clear()
            held.append(frame.iloc[start:end])
        last = tuple(v[-1] for v in values)
    if held:
        yield taken()
