"""Tokenisation against the public library, batches and positions against brute force."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers, trainers

from quernstone.functions import tokens as K
from quernstone.operators import encoding, positions, sampling, vocab

TEXTS = [
    "def f(a, b):\n    return a + b  # don't", "x  =  'we're'\t\n\n  y", "naïve café ２３ 　wide space", "aaaa aaa aa a",
    "for i in range(10):\n\tprint(i)\n", " \xa0 x\x1cy\x85z  ", "日本語 text, mixed—dash", "", " ", "return return return",
]


def library(size):
    tool = Tokenizer(models.BPE(unk_token="<UNK>"))
    tool.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    if size:
        trainer = trainers.BpeTrainer(vocab_size=size, special_tokens=list(K.SPECIAL_TOKENS), show_progress=False)
        tool.train_from_iterator(TEXTS, trainer)
    return tool


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id bigint, line string")


def test_pretokens(texts):
    split = pre_tokenizers.ByteLevel(add_prefix_space=False)
    pieces = F.transform(K.pretokenize(F.col("line")), K.byte_level)
    for row in texts.select("line", pieces.alias("t")).collect():
        assert row.t == [p for p, _ in split.pre_tokenize_str(row.line)]


@pytest.mark.parametrize("size,candidates", [(60, 1 << 16), (110, 12), (400, 1 << 16)])
def test_vocabulary_and_codes(spark, texts, size, candidates, monkeypatch):
    monkeypatch.setattr(vocab, "_REBUILD_MERGES", 20)
    table, merges = vocab.train_bpe(vocab.pretoken_counts(texts), size, candidates)
    tool = library(size)
    assert {r.token: r.id for r in table.collect()} == tool.get_vocab()
    encode = encoding.bpe_encoder(table, merges)
    unseen = texts.unionByName(spark.createDataFrame([(100, "unseen ß words § deff")], "id bigint, line string"))
    rows = unseen.select("line", encode(F.col("line")).alias("ids"))
    for row in rows.collect():
        assert row.ids == tool.encode(row.line).ids
    spoken = encoding.decode(rows.withColumn("row", F.monotonically_increasing_id()), table, key="row")
    for row in spoken.collect():
        assert row.text == tool.decode(row.ids, skip_special_tokens=True)


def test_stored_vocabulary_is_reused(spark, texts, tmp_path):
    calls = []

    def train():
        calls.append(1)
        return vocab.train_bpe(vocab.pretoken_counts(texts), 70)

    path = str(tmp_path / "v")
    states = [vocab.vocab_table(spark, path, train, force)[2] for force in (False, False, True)]
    assert states == ["NEWLY_TRAINED", "REUSED", "NEWLY_TRAINED"] and len(calls) == 2


def test_corpus_is_train_only(spark):
    rows = spark.createDataFrame(
        [(1, "train", "c", "d"), (2, "train", "", "d"), (3, "test", "c", "d")], "id int, split string, code string, docstring string")
    assert [r.line for r in vocab.tokenizer_corpus(rows).orderBy("part").collect()] == ["c", "d"]


def slow_merges(words, size):
    """Merges by a full count in every round, and the number of symbols."""
    ids, merges = {chr(0x10000 + k): k for k in range(26)}, []
    names = {chr(0x10000 + k): chr(97 + k) for k in range(26)}
    while len(ids) < size:
        counts = Counter()
        for seq, n in words.items():
            for p in vocab._pairs(seq):
                counts[p] += n
        if not counts:
            break
        pair = min(counts, key=lambda p: (-counts[p], p))
        name = names[pair[0]] + names[pair[1]]
        new = next((s for s, n in names.items() if n == name), None) or chr(0x10000 + len(ids))
        ids[new], names[new] = ids.get(new, len(ids)), name
        merges.append((ord(pair[0]) - 0x10000, ord(pair[1]) - 0x10000, ids[new]))
        merged = Counter()
        for seq, n in words.items():
            merged[seq.replace(pair, new)] += n
        words = merged
    return merges


@pytest.mark.parametrize("candidates,batch", [(1 << 16, 512), (9, 512), (25, 2)])
def test_merges_equal_full_counts(spark, candidates, batch, monkeypatch):
    """Long words over few letters: many ties, overlaps and tokens that several merges lead to."""
    monkeypatch.setattr(vocab, "_REBUILD_MERGES", 15)
    monkeypatch.setattr(vocab, "_BATCH", batch)
    rng = random.Random(candidates)
    words = Counter("".join(rng.choice("abcab") for _ in range(rng.randrange(1, 14))) for _ in range(50))
    alphabet = "".join(chr(97 + k) for k in range(26))
    words.update({alphabet[k]: 1 for k in range(26)})  # all letters have an id
    symbols = Counter({"".join(chr(0x10000 + ord(c) - 97) for c in w): n for w, n in words.items()})
    counts = spark.createDataFrame(list(words.items()), "pretoken string, n long")
    shift = len(K.SPECIAL_TOKENS)
    got = [(r.left - shift, r.right - shift, r.new - shift) for r in vocab.train_bpe(counts, 400 + shift, candidates)[1].orderBy("rank").collect()]
    want = slow_merges(symbols, 400)
    assert got == want and len({m[2] for m in want}) < len(want)


@pytest.mark.parametrize("limit,candidates", [(1 << 16, 1 << 16), (40, 1 << 16), (1 << 16, 12), (0, 30)])
def test_runs_settle_many_merges(spark, limit, candidates, monkeypatch):
    """Merges from runs, whole or of few pairs, and from the index where no runs fit; the first need no lookups and few rounds."""
    monkeypatch.setattr(vocab, "_RUNS", limit)
    monkeypatch.setattr(vocab, "_FIRST_WIDTH", 16)
    rounds, count = [], vocab.PairIndex.counts
    monkeypatch.setattr(vocab.PairIndex, "counts", lambda self: rounds.append(1) or count(self))
    if limit:
        monkeypatch.setattr(vocab.PairIndex, "merge", lambda *_: pytest.fail("looked up"))
    rng = random.Random(3)
    words = Counter("".join(rng.choice("aabc") for _ in range(rng.randrange(1, 16))) for _ in range(90))
    words.update(chr(97 + k) for k in range(26))
    symbols = Counter({"".join(chr(0x10000 + ord(c) - 97) for c in w): n for w, n in words.items()})
    shift, size = len(K.SPECIAL_TOKENS), 90 if limit == 0 else 300
    counts = spark.createDataFrame(list(words.items()), "pretoken string, n long")
    got = [(r.left - shift, r.right - shift, r.new - shift) for r in vocab.train_bpe(counts, size + shift, candidates)[1].orderBy("rank").collect()]
    want = slow_merges(symbols, size)
    assert got == want
    if limit:
        assert len(want) > 200 and len(rounds) < len(want) / 4


def test_rounds_look_up_only_words_with_a_merged_pair(spark):
    words = spark.createDataFrame([(chr(0x10000 + k) + chr(0x10001 + k), 1) for k in range(0, 400, 2)], vocab.WORDS)
    index = vocab.PairIndex(words)
    pair = chr(0x10000) + chr(0x10001)
    changes = index.merge({pair: chr(0x12000)}, None)
    assert [tuple(r) for r in changes.collect()] == [(pair, -1)]
    plan = changes._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan or "PartitionFilters: [(shard" in plan
    index.close()


def test_batches_stop_where_counts_change():
    def taken(top, known=()):
        made = iter(range(0x12000, 0x13000))
        return list(vocab.take_batch(vocab.Candidates(top, True), 9, lambda p: (chr(next(made)), p in known))[0])

    assert taken([("ab", 9), ("cd", 8), ("bx", 7), ("ef", 6)]) == ["ab", "cd"]
    assert taken([("ab", 9), ("cd", 7), ("ef", 7), ("gh", 7), ("ha", 7)]) == ["ab", "cd", "ef", "gh"]
    assert taken([("aa", 9), ("cd", 7), ("ab", 6)]) == ["aa", "cd"]
    assert taken([("ab", 9), ("cd", 7), ("ef", 6)], {"cd"}) == ["ab", "cd"]
    some = vocab.Candidates([("ab", 9), ("cd", 7)], False)
    some.change("ab", -4)
    assert some.best() == "cd"
    some.drop("cd")
    assert some.best() is None  # a pair that was left out may have 6


def test_a_failed_write_keeps_the_old_vocabulary(spark, texts, tmp_path, monkeypatch):
    path = str(tmp_path / "v")
    small, large = (vocab.train_bpe(vocab.pretoken_counts(texts), n) for n in (60, 70))
    vocab.vocab_table(spark, path, lambda: small)
    broken = large[1].withColumn("left", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        vocab.vocab_table(spark, path, lambda: (large[0], broken), force=True)
    table, merges, status = vocab.vocab_table(spark, path, lambda: pytest.fail("trained again"))
    assert status == "REUSED" and table.count() == 60 and merges.count() == small[1].count()
    table, _, status = vocab.vocab_table(spark, path, lambda: large, force=True)
    assert status == "NEWLY_TRAINED" and table.count() == 70


def test_wrap(spark):
    ids = spark.createDataFrame([([],), ([7] * 10,)], "ids array<int>")
    got = [r[0] for r in ids.select(K.wrap_ids(F.col("ids"), 6)).collect()]
    assert got == [[1, 2], [1, 7, 7, 7, 7, 2]]


def test_padding(spark):
    rows = spark.createDataFrame([(0, [5]), (0, [5, 6, 7]), (1, [8])], "batch_id int, ids array<int>")
    padded = encoding.pad_batch(rows, ("ids",)).collect()
    assert sorted(r.ids for r in padded) == [[5, 0, 0], [5, 6, 7], [8]]
    spent = encoding.padding_economy(rows, {"ids": 10}).first()
    assert (spent.batch_slots, spent.fixed_slots) == (7, 30)


IDS = [0, 3, 4, 9, 10, 11, 500, 501, 90_000, 7]


@pytest.mark.parametrize("width", [1, 4, 65_536])
def test_positions(spark, width):
    rows = spark.createDataFrame([(i, g) for g in ("a", "b") for i in IDS if g == "a" or i < 11], "id bigint, g string")
    got = {(r.g, r.id): r.pos for r in positions.positions_by_id(rows, "id", ["g"], width=width).collect()}
    for g, ids in (("a", sorted(IDS)), ("b", sorted(i for i in IDS if i < 11))):
        assert [got[g, i] for i in ids] == list(range(1, len(ids) + 1))


def test_batches(spark):
    rows = spark.range(100)
    key = sorted(range(100), key=lambda i: hashlib.md5(f"5:{i}".encode()).hexdigest())
    got = {r.id: r.batch_id for r in sampling.assign_batches(rows, 32, seed=5).collect()}
    assert [got[i] for i in key] == [p // 32 for p in range(100)]
    plain = {r.id: r.batch_id for r in sampling.assign_batches(rows, 32).collect()}
    assert plain == {i: i // 32 for i in range(100)}


@pytest.mark.parametrize("step", [1, 3, 1_000_003])
def test_first_rows(spark, step):
    rows = spark.range(0, 1000 * step, step)
    assert sorted(r.id for r in sampling.subset_first_n(rows, 200).collect()) == [i * step for i in range(200)]
    assert sampling.subset_first_n(rows, 5000).count() == 1000
    assert sampling.subset_first_n(rows, 0).count() == 0
    assert sampling.valid_budget(20_003) == 4000


def test_first_rows_per_group(spark):
    rows = spark.range(90).withColumn("g", F.col("id") % 3)
    assert sorted(r.id for r in sampling.first_n_per_group(rows, 2, "g").collect()) == [0, 1, 2, 3, 4, 5]


def test_first_lines_in_file_order(spark):
    lines = spark.createDataFrame(
        [(f, b, s) for f in ("x", "a") for b in (0, 64) for s in range(3)], "file string, block long, seq long"
    ).withColumn("id", F.struct("file", "block", "seq"))
    got = sampling.subset_first_n(lines, 7).orderBy("id").collect()
    assert [(r.file, r.block, r.seq) for r in got] == [
        ("a", 0, 0), ("a", 0, 1), ("a", 0, 2), ("a", 64, 0), ("a", 64, 1), ("a", 64, 2), ("x", 0, 0)]
    batched = sampling.assign_batches(lines, 5).orderBy("id").collect()
    assert [r.batch_id for r in batched] == [0] * 5 + [1] * 5 + [2] * 2
    assert sorted(r.batch_id for r in sampling.assign_batches(lines, 5, seed=1).collect()) == [0] * 5 + [1] * 5 + [2] * 2


def test_long_tokens_merge_in_order():
    import time

    merges = {(4, 4): (0, 5), (5, 5): (1, 6), (6, 6): (2, 7), (5, 4): (3, 8)}
    letters = {"a": 4}

    def slow(word):
        ids = [letters[c] for c in word]
        while options := [(merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]:
            at = min(options)[1]
            ids[at : at + 2] = [merges[ids[at], ids[at + 1]][1]]
        return ids

    for n in range(1, 40):
        assert encoding._merge_word("a" * n, letters, merges) == slow("a" * n)
    start = time.process_time()
    assert len(encoding._merge_word("a" * 20_000, letters, merges)) == 2500
    assert time.process_time() - start < 5


def test_samples_are_bounded_and_repeatable(spark):
    rows = spark.range(50).select("id", F.when(F.col("id") < 4, "test").otherwise("train").alias("split"),
                                  F.lit("c").alias("code"), F.lit("d").alias("docstring"))
    custom = spark.createDataFrame([(-1, "x", "y")], "id bigint, code string, docstring string")
    twice = [sorted((r.suite, r.id) for r in sampling.audit_suites(rows, custom, 10, 3).collect()) for _ in range(2)]
    assert twice[0] == twice[1] and len(twice[0]) == 4 + 10 + 1


def test_half_of_the_rows_under_one_sort_key_spread_over_ranges(spark):
    rows = spark.range(40_000).selectExpr("id AS row", "if(id % 2 = 0, 7, id) AS k", "cast(null AS map<string,int>) AS m")
    placed, total = positions.positions_in_order(rows, ["k"])
    sizes = sorted(spark.read.parquet(name).count() for name in placed.inputFiles())
    assert total == 40_000 and len(sizes) == 4 and sizes[-1] < 2 * sizes[0]
    got = placed.orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1, 40_001)) and [r.k for r in got] == sorted(r.k for r in got)
    again, _ = positions.positions_in_order(rows.repartition(7), ["k"])
    assert {r.row: r.pos for r in again.collect()} == {r.row: r.pos for r in got}
