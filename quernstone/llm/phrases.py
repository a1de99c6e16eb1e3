"""Phrase mining by relations (SETM): sorted occurrences, merge-joined at adjacent places, counted, semi-joined."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quernstone.llm.common import Marks, apart, forget, frugal, lean_batches, marks_of, mix64, slice_hashes, stored

UNDECLARED = "und"
MIN_COUNT = 10
WORDS = 3
TOP = 2000
ABSORBED = 50
BLOCK_WORDS = 1 << 18
STEP_BYTES = 1 << 20
FILE_BYTES = 1 << 24
SALTS = 64
GAP = -1
# Keys are counted by so many of their bits; a task holds about so many before it sends them, and a group has about so many.
COUNTED_BITS, HELD_KEYS, PART_KEYS = 40, 1 << 19, 1 << 19
# Ends of a piece, and the blanks between words.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + ENDS + BLANKS, b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(ENDS) + b" " * len(BLANKS)
)
_FACTORS = [0x9FB21C651E98DF25, 0xD1B54A32D192ED03, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3]
# Words lie joined by blanks and phrases by line feeds, which neither holds; codes, one up, and the steps between places are packed.
OCCURRENCES = "block long, lang string, words string, n array<long>, total long, codes binary"
KEYS = "part long, gaps binary, n binary"
LISTED = "lang string, words string, n array<long>"
COUNTED = "lang string, phrases string, n array<long>"
PLACED = "block long, words string, codes binary, places binary, " + COUNTED


class _Codes(dict):
    """Numbers of tokens in order of appearance."""

    def __missing__(self, token: bytes) -> int:
        number = self[token] = len(self)
        return number


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers by place of their bytes, compressed: what all of them leave empty takes no room."""
    wide = numbers.itemsize
    planes = numbers.astype(f"<u{wide}").view(np.uint8).reshape(-1, wide).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True)


def _unpacked(data: bytes | pa.Buffer, kind: type) -> np.ndarray:
    raw, wide = memoryview(data), np.dtype(kind).itemsize
    planes = pa.Codec("zstd").decompress(pa.py_buffer(raw[8:]), decompressed_size=int.from_bytes(raw[:8], "little"))
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(wide, -1).T).view(kind).ravel()


class _Open:
    """Occurrences of one language that are not written yet: code by place, a gap after every piece."""

    def __init__(self):
        self.known = _Codes({b"": 0, b"\n": 1})
        self.codes = array("i")

    def add(self, text: str) -> None:
        data = text.encode("utf-8", "replace").translate(_FOLD)
        at = 0
        while at < len(data):
            end = data.find(b" ", at + STEP_BYTES)
            end = len(data) if end < 0 else end
            self.codes.extend(map(self.known.__getitem__, data[at:end].replace(b"\n", b" \n ").split(b" ")))
            at = end
        self.codes.append(1)

    def row(self, block: int, lang: str) -> pa.RecordBatch:
        codes = np.frombuffer(self.codes, dtype=np.int32)
        codes = codes[codes > 0]
        codes = codes[np.append(True, (codes[1:] != 1) | (codes[:-1] != 1))] - 2 if len(codes) else codes
        words = list(self.known)[2:]
        inside = codes[codes >= 0]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()), pa.array([lang], pa.string()), pa.array([b" ".join(words).decode("utf-8")], pa.string()),
                pa.array([np.bincount(inside, minlength=len(words))], pa.list_(pa.int64())), pa.array([len(inside)], pa.int64()),
                pa.array([_packed(codes + 1)], pa.binary()),
            ],
            names=["block", "lang", "words", "n", "total", "codes"],
        )


def _blocks(block_words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                one = held.setdefault(lang, None) or _Open()
                held[lang] = one
                one.add(text)
                if len(one.codes) >= block_words or len(held) > 64:
                    yield held.pop(lang).row(number, lang)
                    number += 1
        for lang, one in held.items():
            yield one.row(number, lang)
            number += 1

    return work


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    return slice_hashes(data, np.append(0, ends[:-1]), ends) if words else np.empty(0, np.uint64)


def _dictionary_hashes(batch: pa.RecordBatch, row: int) -> np.ndarray:
    """The hash of each word of a block, by code."""
    words = batch.column("words")[row].as_py()
    return _word_hashes(words.encode("utf-8").split(b" ") if words else [])


def _keys(lang: str, hashes: np.ndarray, codes: np.ndarray, starts: np.ndarray, words: int) -> np.ndarray:
    """A 64-bit key of the phrases of ``words`` words that start at some places."""
    total = np.full(len(starts), np.uint64(words * 0x9E3779B1 + zlib.crc32(lang.encode("utf-8", "replace"))))
    for k in range(words):
        factor = np.uint64((_FACTORS[k % len(_FACTORS)] + 2 * k) & ((1 << 64) - 1))
        total += hashes[codes[starts + k]] * factor
    return mix64(total)


def _adjacent(places: np.ndarray) -> np.ndarray:
    """Merge-join of a sorted relation with itself at the next place; a gap lies between pieces."""
    return places[:-1][places[1:] == places[:-1] + 1]


def _groups(codes: np.ndarray, starts: np.ndarray, words: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact grouping of the phrases at ``starts``: a place of each, the group of each place, sizes."""
    label = codes[starts].astype(np.int64)
    for k in range(1, words):
        if k > 1:
            label = np.unique(label, return_inverse=True)[1]
        label = label * size + codes[starts + k]
    first, group, n = np.unique(label, return_index=True, return_inverse=True, return_counts=True)[1:]
    return starts[first], group, n


class _Extended:
    """One block with its phrases of ``words`` words, all of whose shorter parts may be frequent."""

    def __init__(self, batch: pa.RecordBatch, row: int, words: int, singles: Marks):
        lang, hashes = batch.column("lang")[row].as_py(), _dictionary_hashes(batch, row)
        self.codes = _unpacked(batch.column("codes")[row].as_buffer(), np.int32) - 1
        if words == 2:
            every = np.arange(len(hashes))
            frequent = np.append(singles(_keys(lang, hashes, every, every, 1)), False)
            held = np.flatnonzero(frequent[self.codes])
        else:
            held = np.cumsum(_unpacked(batch.column("places")[row].as_buffer(), np.int32), dtype=np.int32)
        self.starts = _adjacent(held)
        self.at, self.group, self.n = _groups(self.codes, self.starts, words, len(hashes))
        self.keys = _keys(lang, hashes, self.codes, self.at, words)


def _counted_key(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(64 - COUNTED_BITS)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its counts."""
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _sent(held: list[tuple[np.ndarray, np.ndarray]], parts: int) -> pa.RecordBatch:
    """Keys and counts of some blocks, summed: a row for each of the ``parts`` equal ranges of keys that holds some."""
    keys, n = _summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
    bounds = [(part << COUNTED_BITS) // parts for part in range(parts + 1)]
    cuts = np.searchsorted(keys, np.array(bounds, dtype=np.uint64))
    rows = [
        (part, _packed(np.diff(keys[start:end], prepend=np.uint64(0))), _packed(n[start:end]))
        for part, (start, end) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if end > start
    ]
    columns = list(zip(*rows)) or [()] * 3
    kinds = (pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "gaps", "n"])


def _group_counts(words: int, singles, parts: int):
    def counted(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
        if words == 1:
            hashes = _dictionary_hashes(batch, row)
            every = np.arange(len(hashes))
            keys, n = _keys(batch.column("lang")[row].as_py(), hashes, every, every, 1), batch.column("n")[row].values.to_numpy()
        else:
            own = _Extended(batch, row, words, singles and singles.value)
            keys, n = own.keys, own.n
        return _counted_key(keys), n.astype(np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                held.append(counted(batch, row))
                many += len(held[-1][0])
                if many >= HELD_KEYS:
                    yield _sent(held, parts)
                    held, many = [], 0
        if many:
            yield _sent(held, parts)

    return work


def _frequent_keys(min_count: int):
    def work(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.cumsum(_unpacked(gaps, np.uint64), dtype=np.uint64) for gaps in table.column("gaps").to_pylist()])
        keys, n = _summed(keys, np.concatenate([_unpacked(counts, np.int64) for counts in table.column("n").to_pylist()]))
        return pa.table({"key": pa.array(keys[n >= min_count].view(np.int64))})

    return work


def _frequent_words(marks):
    """Words and counts of a block without those that no mark is set for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                lang, hashes = batch.column("lang")[row].as_py(), _dictionary_hashes(batch, row)
                every = np.arange(len(hashes))
                stays = marks.value(_counted_key(_keys(lang, hashes, every, every, 1)))
                words = pa.array(batch.column("words")[row].as_py().split(" ")).take(pa.array(np.flatnonzero(stays)))
                n = batch.column("n")[row].values.to_numpy()[stays] if len(hashes) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()), pa.array([" ".join(words.to_pylist())], pa.string()), pa.array([n], pa.list_(pa.int64()))],
                    names=["lang", "words", "n"],
                )

    return work


def _semi_join(words: int, singles, marks, last: bool):
    """The phrases that marks are set for; unless they are the ``last`` and longest, their places and the block go along."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own = _Extended(batch, row, words, singles and singles.value)
                stays = marks.value(_counted_key(own.keys))
                dictionary = pa.array(batch.column("words")[row].as_py().split(" "))
                columns = [dictionary.take(pa.array(own.codes[own.at[stays] + k])) for k in range(words)]
                phrases = "\n".join(pc.binary_join_element_wise(*columns, " ").to_pylist())
                found = {
                    "lang": batch.column("lang").slice(row, 1), "phrases": pa.array([phrases], pa.string()),
                    "n": pa.array([own.n[stays]], pa.list_(pa.int64())),
                }
                if not last:
                    places = own.starts[stays[own.group]].astype(np.int32)
                    steps = _packed(np.diff(places, prepend=np.int32(0)))
                    same = {name: batch.column(name).slice(row, 1) for name in ("block", "words", "codes")}
                    found = {**same, "places": pa.array([steps], pa.binary()), **found}
                yield pa.RecordBatch.from_pydict(found)

    return work


def _kept(df: DataFrame, label: str) -> DataFrame:
    """Stored in small row groups, as a row is a whole block."""
    return stored(df, label, **{"parquet.block.size": str(FILE_BYTES), "compression": "zstd"})


def _listed(text: str, mark: str) -> Column:
    """``text`` taken apart beside its counts, a row each."""
    return F.explode(F.arrays_zip(F.split(text, mark).alias("phrase"), F.col("n").alias("a"))).alias("p")


def _word_key(lang: str, word: str) -> Column:
    """The key of a phrase of one word, as the occurrences have it."""

    @F.pandas_udf("long")
    def keyed(langs: pd.Series, words: pd.Series) -> pd.Series:
        hashes = _word_hashes([w.encode("utf-8") for w in words])
        out = np.empty(len(words), dtype=np.int64)
        for one in langs.unique():
            at = np.flatnonzero((langs == one).to_numpy())
            out[at] = _keys(one, hashes, at, np.arange(len(at)), 1).view(np.int64)
        return pd.Series(out)

    return keyed(lang, word)


def frequent_phrases(
    docs: DataFrame, words: int = WORDS, min_count: int = MIN_COUNT, text_col: str = "text", lang_col: str = "lang",
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, a`` of all phrases of up to ``words`` words met ``min_count`` times, and ``lang, n``.

    Pieces end at ``.,;:!?`` and line ends, words are what blanks and tabs leave, A-Z count as lower
    case, and languages are counted apart. The occurrences are written once, sorted by piece and place:
    blocks of whole texts of one language, a code per place and a gap after each piece. A longer
    relation comes from the stored shorter one by a merge-join with itself at the next place of the
    piece; its groups are counted over all blocks; the frequent ones mark bits in a map of bounded size,
    and the occurrences are semi-joined with it and written before they are extended again. A bit that
    another group has set lets occurrences through that are counted in vain: phrases are counted by
    their words in the end, so counts and results are exact whatever the map lets pass. Only counts
    move; occurrences stay in their blocks. Groups are counted by ``COUNTED_BITS`` of a hash, which move
    sorted, as compressed differences, by ranges of that hash; words and phrases themselves move only
    where their key is frequent, summed up by each task before.
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDECLARED)).alias("lang")
    texts = docs.select(lang, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def frequent(rows: DataFrame, column: str, mark: str, length: int) -> DataFrame:
        met = rows.select("lang", _listed(column, mark)).filter("p.a IS NOT NULL").select("lang", "p.phrase", "p.a")
        counted = met.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
        return stored(counted.filter(F.col("a") >= min_count).select("lang", "phrase", F.lit(length).alias("words"), "a"), "phrases")

    lean_batches(spark)
    held = _kept(texts.mapInArrow(frugal(_blocks(block_words)), OCCURRENCES), "occurrences")
    sizes = stored(held.groupBy("lang").agg(F.sum("total").alias("n")), "sizes")
    parts = max(1, -(-(sizes.agg(F.sum("n")).first()[0] or 0) // PART_KEYS))

    def frequent_keys(rows: DataFrame, length: int, singles) -> DataFrame:
        sent = rows.mapInArrow(frugal(_group_counts(length, singles, parts)), KEYS)
        return stored(sent.groupBy("part").applyInArrow(_frequent_keys(min_count), "key long"), "keys")

    listed = held.select("lang", "words", "n")
    keys = frequent_keys(listed, 1, None)
    marks = spark.sparkContext.broadcast(marks_of(keys, keys.count()))
    found = [frequent(listed.mapInArrow(frugal(_frequent_words(marks)), LISTED), "words", " ", 1)]
    forget(keys)
    marks = spark.sparkContext.broadcast(marks_of(found[0].select(_word_key("lang", "phrase").alias("key")), found[0].count()))
    for length in range(2, words + 1):
        before = marks if length == 2 else None
        needed = ["lang", "words", "codes", *(["places"] if length > 2 else [])]
        keys = frequent_keys(held.select(*needed), length, before)
        marks = spark.sparkContext.broadcast(marks_of(keys, keys.count()))
        last = length == words
        joined = _kept(held.select("block", *needed).mapInArrow(frugal(_semi_join(length, before, marks, last)), COUNTED if last else PLACED), "occurrences")
        found.append(frequent(joined, "phrases", "\n", length))
        forget(held)
        forget(keys)
        held = joined
    forget(held)
    return reduce(DataFrame.unionByName, found), sizes


def _part(start: Column, count: Column) -> Column:
    return F.array_join(F.slice(F.col("parts"), start, count), " ")


def collocations(
    docs: DataFrame, words: int = WORDS, min_count: int = MIN_COUNT, top: int = TOP, absorbed: int = ABSORBED,
    text_col: str = "text", lang_col: str = "lang", block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two to ``words`` words of each language.

    ``a`` counts the phrase (see :func:`frequent_phrases`), ``l`` and ``r`` the two parts of the cut
    with the lowest ``floor(1000000 * a * a / (l * r))``, the earliest of equal ones; decimals of 38
    digits keep that exact for counts below 10**15. A phrase that is ``absorbed`` percent of the time or
    more inside one longer candidate is dropped, whether that one is dropped itself or not.

    A null language is ``und``; null and blank texts have no words. Texts of any length are read whole, in
    steps. Repeated rows count again, null and repeated ids do not matter, other columns are ignored. Ties
    of score and count go by the bytes of the phrase. Empty tables give no rows.
    """
    every, sizes = frequent_phrases(docs, words, min_count, text_col, lang_col, block_words)
    groups = stored(every, "groups")
    candidates = groups.filter("words > 1").withColumn("parts", F.split("phrase", " "))
    inner = [
        candidates.filter(F.col("words") > size)
        .select("lang", "parts", "a", F.explode(F.sequence(F.lit(1), F.col("words") - size + 1)).alias("at"))
        .select("lang", _part(F.col("at"), F.lit(size)).alias("phrase"), "a")
        for size in range(2, words)
    ]
    kept = candidates
    if inner:
        longer = reduce(DataFrame.unionByName, inner).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
        kept = candidates.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < absorbed * F.col("a")))
    cuts = kept.select("lang", "phrase", "words", "parts", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", _part(F.lit(1), F.col("cut")).alias("left"), _part(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("right")
    )
    sides = stored(cuts, "cuts")
    for side, name in (("left", "l"), ("right", "r")):
        sides = sides.join(apart(groups.select("lang", F.col("phrase").alias(side), F.col("a").alias(name)), "lang", side), ["lang", side])
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r")}
    score = F.expr("div(CAST(1000000 AS DECIMAL(7,0)) * wa * wa, wl * wr)").alias("score")
    scored = sides.select("lang", "phrase", "a", "cut", "l", "r", *[c.alias(f"w{n}") for n, c in wide.items()]).select("lang", "phrase", "a", "cut", "l", "r", score)
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best")).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = lowest.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("_at", F.row_number().over(W.partitionBy("lang", "_salt").orderBy(*order))).filter(F.col("_at") <= top)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
