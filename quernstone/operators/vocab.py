"""Sub-word vocabulary: corpus, pre-token counts, byte-pair merges, the stored table."""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import tokens as K
from quernstone.session import forget, remove, scratch_path, stored

VOCAB_SIZE = 20_000
VOCAB_SCHEMA = "id int, token string"
MERGE_SCHEMA = "rank int, left int, right int, new int"
WORDS = "seq string, n long"
CHANGES = "pair string, n long"

# Symbols are single characters from here on, so that merging a pair is a plain string replace and
# the byte order of two symbols is the order of their ids.
_SYMBOL_BASE = 0x10000
_CANDIDATES = 1 << 16
_BATCH = 512
_REBUILD_MERGES = 1_500
_RUNS = 1 << 16
_FIRST_WIDTH = 256


def tokenizer_corpus(refined: DataFrame) -> DataFrame:
    """Code and docstring of complete training rows as separate lines."""
    train = refined.filter((F.col("split") == "train") & (F.col("code") != "") & (F.col("docstring") != ""))
    return train.select("id", F.posexplode(F.array("code", "docstring")).alias("part", "line"))


def pretoken_counts(lines: DataFrame, text: str = "line", split: Column | None = None) -> DataFrame:
    """Frequency of every pre-token; counted per task first, so common tokens are cheap."""
    pieces = K.pretokenize(F.col(text)) if split is None else split
    return lines.select(F.explode(pieces).alias("pretoken")).groupBy("pretoken").agg(
        F.count("*").alias("n")
    )


def _symbol(token_id: int) -> str:
    return chr(_SYMBOL_BASE + token_id)


def _id(symbol: str) -> int:
    return ord(symbol) - _SYMBOL_BASE


def _pairs_of(seq: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(seq) - 1), lambda i: F.substring(seq, i, F.lit(2)))


def _apply(seq: str, merges: Mapping[str, tuple[int, str]]) -> str:
    """``seq`` after all merges that fit, the earliest first, each from left to right."""
    while True:
        fits = [(merges[p][0], p) for p in {seq[i : i + 2] for i in range(len(seq) - 1)} if p in merges]
        if not fits:
            return seq
        pair = min(fits)[1]
        seq = seq.replace(pair, merges[pair][1])


def _pairs(seq: str) -> list[str]:
    return [seq[i : i + 2] for i in range(len(seq) - 1)]


class Candidates:
    """The most frequent pairs with exact counts, at most so many, and where what lies beyond them begins.

    A pair of old symbols only ever loses occurrences, and one with a new symbol has none but those its
    round has reported. So pairs that were left out stay behind ``last``, and a pair up to there is the best of all.
    """

    def __init__(self, top: Iterable[tuple[str, int]], complete: bool):
        self.counts = dict(top)
        self.heap = [(-n, pair) for pair, n in self.counts.items()]
        heapq.heapify(self.heap)
        self.last = None if complete or not self.heap else max(self.heap)

    def best(self) -> str | None:
        """The pair to merge next, if it is certain."""
        while self.heap:
            n, pair = self.heap[0]
            if self.counts.get(pair) != -n:
                heapq.heappop(self.heap)
            elif self.last is not None and (n, pair) > self.last:
                return None
            else:
                return pair
        return None

    def drop(self, pair: str) -> None:
        del self.counts[pair]

    def change(self, pair: str, n: int) -> None:
        now = self.counts.get(pair, 0) + n
        if now > 0:
            self.counts[pair] = now
            heapq.heappush(self.heap, (-now, pair))
        else:
            self.counts.pop(pair, None)


def take_batch(candidates: Candidates, limit: int, add: Callable[[str], tuple[str, bool]]) -> tuple[dict[str, str], str | None]:
    """Leading pairs that merging one by one would take in just this order, and their symbols; the one that is reused.

    Merging (a, b) changes the counts of pairs that end in a or start with b, so the batch ends before
    the first such pair. New pairs can tie with the next one but not beat it: (x, ab) is no more
    frequent than (x, a), which would have come before the next pair and ended the batch, or shares its
    left symbol or has a later one; (ab, y) starts with a new symbol. ``add`` names the symbol of a pair
    and says whether it was known, by other merges, before; that ends a batch too.
    """
    batch: dict[str, str] = {}
    lefts: set[str] = set()
    rights: set[str] = set()
    while len(batch) < limit and (pair := candidates.best()) is not None:
        if pair[1] in lefts or pair[0] in rights:
            break
        batch[pair], known = add(pair)
        candidates.drop(pair)
        lefts.add(pair[0])
        rights.add(pair[1])
        if known:
            return batch, batch[pair]
    return batch, None


class Runs:
    """Stretches of words in which all neighbours are leading pairs, with their frequency, held on the driver.

    Where two neighbours are no leading pair, nothing certain crosses: what merges on either side meets no
    more often than they do. So merges that are certain and lead to new symbols can be counted here alone.
    """

    def __init__(self, runs: Iterable[tuple[str, int]]):
        self.seqs, self.n = map(list, zip(*runs)) if (runs := list(runs)) else ([], [])
        self.places: dict[str, set[int]] = {}
        for at, seq in enumerate(self.seqs):
            for p in _pairs(seq):
                self.places.setdefault(p, set()).add(at)

    def merge(self, batch: dict[str, str]) -> list[tuple[str, int]]:
        """Apply a batch and return by how much the count of each pair changes."""
        new = {pair: (k, symbol) for k, (pair, symbol) in enumerate(batch.items())}
        changes: Counter[str] = Counter()
        for at in set().union(*[self.places.pop(pair, ()) for pair in batch]):
            before, n = self.seqs[at], self.n[at]
            after = self.seqs[at] = _apply(before, new)
            for p in _pairs(before):
                changes[p] -= n
            for p in _pairs(after):
                changes[p] += n
                self.places.setdefault(p, set()).add(at)
        return [(p, n) for p, n in changes.items() if n]


class PairIndex:
    """Words by the pairs they hold, as stored tables: ``seq, n`` and, dealt by pair, ``pair, seq, n``.

    The index is made when a merge first asks for it, and is as of the last rebuild. A merge since then
    joins two symbols where two older ones meet, so the words that may hold its pair are found under that
    older pair; every other word is left alone. Words of one symbol leave when the words are rebuilt.
    """

    def __init__(self, words: DataFrame, label: str = "bpe-words"):
        self.spark = words.sparkSession
        self.shards = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self._start(stored(words.filter(F.length("seq") > 1).repartition(self.shards), label))

    def _start(self, words: DataFrame) -> None:
        self.words = words
        self.path: str | None = None
        self.merges: dict[str, tuple[int, str]] = {}
        self.first: dict[str, set[str]] = {}
        self.last: dict[str, set[str]] = {}

    def _build(self) -> None:
        held = self.words.select(F.explode(F.array_distinct(_pairs_of(F.col("seq")))).alias("pair"), "seq", "n")
        dealt = held.withColumn("shard", F.pmod(F.crc32(F.col("pair").cast("binary")), F.lit(self.shards)).cast("int"))
        self.path = scratch_path(self.spark, "bpe-index")
        dealt.repartition("shard").write.partitionBy("shard").parquet(self.path)
        self.index = self.spark.read.schema(dealt.schema).parquet(self.path)

    def rebuild(self) -> None:
        """Store the words as the merges since the last rebuild have left them, and index them anew."""
        merges = self.merges

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                seqs = [_apply(s, merges) for s in batch.column("seq").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(seqs, pa.string()), batch.column("n")], names=["seq", "n"])

        merged = stored(self.words.mapInArrow(work, WORDS).filter(F.length("seq") > 1), "bpe-words")
        self.close()
        self._start(merged)

    def close(self) -> None:
        forget(self.words)
        if self.path:
            remove(self.spark, self.path)

    def counts(self) -> DataFrame:
        """``pair, n`` over all words; the index must be rebuilt first if merges are pending."""
        return self.words.select(F.explode(_pairs_of(F.col("seq"))).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))

    def runs(self, pairs: Iterable[str], limit: int) -> Runs | None:
        """The runs of ``pairs`` in all words, or nothing if there are more than ``limit``."""
        linked = frozenset(pairs)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found: Counter[str] = Counter()
                for seq, n in zip(*[batch.column(c).to_pylist() for c in ("seq", "n")]):
                    start = 0
                    for at in range(1, len(seq) + 1):
                        if at == len(seq) or seq[at - 1 : at + 1] not in linked:
                            if at - start > 1:
                                found[seq[start:at]] += n
                            start = at
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["seq", "n"])

        found = self.words.mapInArrow(work, WORDS).groupBy("seq").agg(F.sum("n").alias("n")).limit(limit + 1).collect()
        return Runs((r["seq"], r["n"]) for r in found) if len(found) <= limit else None

    def note(self, batch: dict[str, str]) -> None:
        """Keep a batch that has been counted elsewhere for the next rebuild."""
        for pair, symbol in batch.items():
            self.merges[pair] = (len(self.merges), symbol)

    def merge(self, batch: dict[str, str], reused: str | None) -> DataFrame:
        """Apply a batch and return ``pair, n``: by how much the count of each pair changes.

        ``reused`` is the symbol of the batch that words may hold already.
        """
        if not self.path:
            self._build()
        meets = {x + y for pair in batch for x in self.last.get(pair[0], {pair[0]}) for y in self.first.get(pair[1], {pair[1]})}
        old = dict(self.merges)
        for pair, symbol in batch.items():
            self.merges[pair] = (len(self.merges), symbol)
            own = {symbol} if symbol == reused else set()
            self.first[symbol] = self.first.get(symbol, own) | self.first.get(pair[0], {pair[0]})
            self.last[symbol] = self.last.get(symbol, own) | self.last.get(pair[1], {pair[1]})
        new = {pair: self.merges[pair] for pair in batch}

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            changes: Counter[str] = Counter()
            for table in batches:
                for pair, seq, n in zip(*[table.column(c).to_pylist() for c in ("pair", "seq", "n")]):
                    if next(p for p in _pairs(seq) if p in meets) != pair:
                        continue  # the word comes up under another of its pairs
                    before = _apply(seq, old)
                    after = _apply(before, new)
                    if before != after:
                        for p in _pairs(before):
                            changes[p] -= n
                        for p in _pairs(after):
                            changes[p] += n
            some = [(p, n) for p, n in changes.items() if n]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], names=["pair", "n"])

        shards = sorted({zlib.crc32(p.encode()) % self.shards for p in meets})
        found = self.index.filter(F.col("shard").isin(shards) & F.col("pair").isin(sorted(meets))).select("pair", "seq", "n")
        return found.mapInArrow(work, CHANGES).groupBy("pair").agg(F.sum("n").alias("n")).filter("n <> 0")


def train_bpe(counts: DataFrame, vocab_size: int = VOCAB_SIZE, candidates: int = _CANDIDATES) -> tuple[DataFrame, DataFrame]:
    """Learn byte-pair merges from ``pretoken, n``; returns ``vocab`` and ``merges`` tables.

    Highest count first, ties by smaller ids. A round counts all pairs and brings the leading ones to the
    driver, at most ``candidates``, with the runs of words they make up (:class:`Runs`), at most ``_RUNS``: as
    many pairs lead as fit. All merges that are certain among them follow from the runs, so a round settles
    about as many merges as pairs lead. A token that another merge has made before ends a round, unless the
    runs are the words themselves. Where even the runs of one pair are too many, a round looks up the words
    that hold a merged pair in a stored index (:class:`PairIndex`), a batch at a time (:func:`take_batch`).
    """
    spark = counts.sparkSession
    glyphs = counts.select(K.byte_level(F.col("pretoken")).alias("token"), "n")
    letters = sorted(r[0] for r in glyphs.select(F.explode(F.split("token", ""))).distinct().collect() if r[0])
    tokens = [*K.SPECIAL_TOKENS, *letters]
    ids = {t: i for i, t in enumerate(tokens)}
    merges: list[tuple[int, int, int, int]] = []

    def add(pair: str) -> tuple[str, bool]:
        left, right = _id(pair[0]), _id(pair[1])
        token = tokens[left] + tokens[right]
        known = token in ids
        if not known:
            ids[token] = len(tokens)
            tokens.append(token)
        merges.append((len(merges), left, right, ids[token]))
        return _symbol(ids[token]), known

    symbols = "".join(_symbol(ids[c]) for c in letters)
    index = PairIndex(glyphs.select(F.translate("token", "".join(letters), symbols).alias("seq"), F.col("n").cast("long")))
    leading, runs = None, None
    width = candidates if index.words.count() <= _RUNS else min(candidates, _FIRST_WIDTH)
    while len(tokens) < vocab_size:
        if leading is None or leading.best() is None:
            if leading is not None and leading.last is None:
                break  # all pairs were known, and none is left
            if index.merges:
                index.rebuild()
            top = [(r["pair"], r["n"]) for r in index.counts().orderBy(F.desc("n"), "pair").limit(width).collect()]
            if not top:
                break
            lead = top
            while (runs := index.runs([p for p, _ in lead], _RUNS)) is None and len(lead) > 1:
                lead = lead[: len(lead) // 4 or 1]
            complete = len(top) < width and (runs is None or lead is top)
            leading = Candidates(top if runs is None else lead, complete)
            if runs is not None and not complete:
                width = min(candidates, 4 * len(lead) if 4 * len(runs.seqs) < _RUNS else len(lead))
        batch, reused = take_batch(leading, min(_BATCH, vocab_size - len(tokens)), add)
        if runs is not None:
            index.note(batch)
            changes = runs.merge(batch)
        else:
            changes = index.merge(batch, reused)
        if reused and leading.last is not None:  # pairs that were left out may have grown
            leading = None
            continue
        if runs is not None:
            found = changes
        elif leading.last is None:
            found = changes.collect()
        else:
            lefts, rights = {p[0] for p in batch}, {p[1] for p in batch}
            touched = [p for p in leading.counts if p[1] in lefts or p[0] in rights]
            found = changes.filter((F.col("n") >= -leading.last[0]) | F.col("pair").isin(touched)).collect()
        for pair, n in found:
            if n > 0 or pair in leading.counts:
                leading.change(pair, n)
        if runs is None and (reused or len(index.merges) >= _REBUILD_MERGES):
            index.rebuild()
    index.close()
    vocab = spark.createDataFrame(list(enumerate(tokens)), VOCAB_SCHEMA)
    return vocab, spark.createDataFrame(merges, MERGE_SCHEMA)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/published")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(int(f.getPath().getName()) for f in files.listStatus(folder)) if files.exists(folder) else []


def publish(spark: SparkSession, path: str, vocab: DataFrame, merges: DataFrame) -> int:
    """Store a vocabulary with its merges as a new version and, when both are whole, name it.

    A version is a folder of its own; an empty file under ``published``, created in one step and
    last, makes it count. Whatever fails before that leaves the version before in place.
    """
    number = max(_versions(spark, path), default=0) + 1
    vocab.write.mode("overwrite").parquet(f"{path}/version={number}/vocab")
    merges.write.mode("overwrite").parquet(f"{path}/version={number}/merges")
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/published/{number}")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).create(mark, False).close()
    return number


def vocab_table(
    spark: SparkSession,
    path: str,
    train: Callable[[], tuple[DataFrame, DataFrame]],
    force: bool = False,
) -> tuple[DataFrame, DataFrame, str]:
    """Stored ``vocab`` and ``merges`` and how they came about: ``REUSED`` or ``NEWLY_TRAINED``."""
    known = _versions(spark, path)
    status = "REUSED" if known and not force else "NEWLY_TRAINED"
    number = known[-1] if status == "REUSED" else publish(spark, path, *train())
    vocab = spark.read.schema(VOCAB_SCHEMA).parquet(f"{path}/version={number}/vocab")
    merges = spark.read.schema(MERGE_SCHEMA).parquet(f"{path}/version={number}/merges")
    return vocab, merges, status


def vocab_info(vocab: DataFrame, status: str) -> DataFrame:
    return vocab.agg(F.count("*").alias("vocab_size")).withColumn("status", F.lit(status))
