"""Pack tokenised documents into fixed-size sequences by vector best fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import frugal, lean_batches, stored, stored_with
from quernstone.llm.tokens import END_ID, shared_encoder

SEQUENCE = 1024
GROUP_PIECES = 8_192
STEP_BYTES = 1 << 21
PIECES = "key long, doc_id long, piece int, start long, length long, ids_crc32 long"
# Ids below 2**16 go as 16-bit numbers, moved into their range; a piece with a larger one has 32 bits each.
NARROW, WIDE, SHIFT = 1 << 16, "narrow array<short>, wide array<int>", 1 << 15
RULES = ("norm", "dot")


def _cut_points(length: int, size: int) -> list[tuple[int, int]]:
    """Start and length of each piece: the first takes what the full ones leave."""
    first = length % size
    cuts = [(0, first)] if first else []
    return cuts + [(at, size) for at in range(first, length, size)]


def _by_width(offsets: np.ndarray, flat: np.ndarray) -> dict[str, pa.Array]:
    """Columns ``narrow`` and ``wide`` of pieces of ids, none of them empty: of each piece one of the two, the other null."""
    at, large = pa.array(offsets.astype(np.int32)), (flat < 0) | (flat >= NARROW)
    moved = pa.array((flat - SHIFT).astype(np.int16))
    if not large.any():
        return {"narrow": pa.ListArray.from_arrays(at, moved), "wide": pa.nulls(len(offsets) - 1, pa.list_(pa.int32()))}
    wide = np.logical_or.reduceat(large, offsets[:-1])
    return {
        "narrow": pa.ListArray.from_arrays(at, moved, mask=pa.array(wide)),
        "wide": pa.ListArray.from_arrays(at, pa.array(flat), mask=pa.array(~wide)),
    }


def _of_any_width() -> Column:
    """The ids behind ``narrow`` and ``wide``."""
    return F.coalesce(F.transform("narrow", lambda x: x.cast("int") + SHIFT), F.col("wide")).alias("ids")


def _tokenised(size: int, with_ids: bool, by_width: bool, vocabulary: str | None, ranks: str | None):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, made = shared_encoder(vocabulary, ranks), TaskContext.get().partitionId() << 36
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            at = 0
            for end in [*np.flatnonzero(np.diff(np.cumsum(sizes) // STEP_BYTES)).tolist(), batch.num_rows - 1]:
                part = batch.slice(at, end + 1 - at)
                at = end + 1
                ids, counts = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                flat = np.insert(ids.astype("<i4"), np.cumsum(counts), END_ID)
                doc, piece, start, length = [], [], [], []
                for row, n in enumerate((counts + 1).tolist()):
                    for k, (a, b) in enumerate(_cut_points(n, size)):
                        doc.append(row)
                        piece.append(k)
                        start.append(a)
                        length.append(b)
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
                raw = memoryview(flat.tobytes())
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                columns = {
                    "key": pa.array(np.arange(made, made + len(doc)), pa.int64()), "doc_id": part.column("doc_id").take(pa.array(doc, pa.int64())),
                    "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
                if by_width:
                    columns |= _by_width(offsets, flat)
                elif with_ids:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
                made += len(doc)
                yield pa.RecordBatch.from_pydict(columns)

    return work


def token_pieces(
    docs: DataFrame, size: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
    vocabulary: str | None = None, ranks: str | None = None,
) -> DataFrame:
    """``key, doc_id, piece, start, length, ids_crc32`` and, if wanted, ``ids``: whole texts as ids with an end id.

    Longer ones are cut into pieces of ``size``. ``key`` numbers the pieces by task and place; it holds
    for a stored table only. Texts are taken ``STEP_BYTES`` at a time, a longer one alone, at some 60
    bytes of memory for each of its own.
    """
    return _pieces(docs, size, id_col, text_col, with_ids, False, vocabulary, ranks)


def _pieces(
    docs: DataFrame, size: int, id_col: str, text_col: str, with_ids: bool, by_width: bool, vocabulary: str | None, ranks: str | None
) -> DataFrame:
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ids = [WIDE] if by_width else ["ids array<int>"] if with_ids else []
    return texts.mapInArrow(frugal(_tokenised(size, with_ids, by_width, vocabulary, ranks)), ", ".join([PIECES, *ids]))


def best_fit(
    lengths: np.ndarray, size: int = SEQUENCE, documents: int | None = None, attention: int | None = None, rule: str = "norm"
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, placed in the given order.

    A bin has three capacities: tokens, documents (``documents``; ``size`` if none) and attention cost,
    the sum of squared lengths (``attention``; ``size`` squared if none). Among the bins that hold the
    piece under all three, rule ``norm`` takes the one whose residual, as shares of the capacities, has
    the smallest norm afterwards; rule ``dot`` the one with the smallest product of residual and demand.
    Ties go to the older bin. A piece that fits nowhere opens a bin; it must fit into an empty one.
    """
    caps = np.array([size, documents or size, attention or size * size], dtype=np.int64)
    shares = 1.0 / caps
    n = len(lengths)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    left = np.empty((n, 3), dtype=np.int64)
    number, fill = np.empty(n, np.int64), np.zeros(n, np.int64)
    open_bins = made = 0
    shortest = np.minimum.accumulate(lengths[::-1])[::-1] if n else lengths
    for at, length in enumerate(lengths.tolist()):
        demand = np.array([length, 1, length * length])
        if (demand > caps).any():
            raise ValueError("a piece exceeds the capacity of an empty sequence")
        rest = left[:open_bins]
        fits = np.flatnonzero((rest[:, 0] >= length) & (rest[:, 1] >= 1) & (rest[:, 2] >= demand[2]))
        if len(fits):
            if rule == "norm":
                after = (rest[fits] - demand) * shares
                score = (after * after).sum(axis=1)
            else:
                score = (rest[fits] * shares) @ (demand * shares)
            row = fits[np.argmin(score)]
        else:
            row = open_bins
            left[row], number[row], fill[row] = caps, made, 0
            open_bins += 1
            made += 1
        bins[at], offsets[at] = number[row], fill[row]
        left[row] -= demand
        fill[row] += length
        least = shortest[at + 1] if at + 1 < n else size + 1
        if left[row, 0] < least or left[row, 1] < 1 or left[row, 2] < least * least:  # no later piece fits
            open_bins -= 1
            if row != open_bins:
                left[row], number[row], fill[row] = left[open_bins], number[open_bins], fill[open_bins]
    return bins, offsets


def _packed(size: int, documents: int | None, attention: int | None, rule: str):
    def work(key: tuple, table: pa.Table) -> pa.Table:
        lengths, keys = table.column("length").to_numpy(), table.column("key").to_numpy()
        order = np.lexsort((keys, -lengths))
        bins, offsets = best_fit(lengths[order], size, documents, attention, rule)
        first = int(key[0].as_py()) << 32
        return pa.table({"key": keys[order], "sequence_id": bins + first, "offset": offsets})

    return work


def place_pieces(
    pieces: DataFrame, count: int, size: int = SEQUENCE, documents: int | None = None, attention: int | None = None, rule: str = "norm",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """``key, sequence_id, offset`` for pieces ``key, length``, of which there are ``count``.

    Nothing but two numbers of each piece moves. Pieces are dealt by a hash of their own key into groups
    of about ``group_pieces``, at most ``size`` tokens each, whatever ids or texts repeat, and packed
    inside each group in order of falling length (see :func:`best_fit`); a task holds one group. A group
    wastes a few sequences at most.
    """
    groups = max(1, -(-count // group_pieces))
    dealt = pieces.select("key", "length", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("long").alias("_group"))
    return dealt.groupBy("_group").applyInArrow(_packed(size, documents, attention, rule), "key long, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, size: int = SEQUENCE, documents: int | None = None, attention: int | None = None, rule: str = "norm",
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, group_pieces: int = GROUP_PIECES,
    vocabulary: str | None = None, ranks: str | None = None,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and ``ids``: every piece and its place.

    Documents become ids and one end id; longer ones are cut into full pieces after a first, shorter one.
    The pieces are stored once; their lengths are packed (see :func:`place_pieces`) and the places joined
    back by key. On that way ids take 16 bits each, 32 in pieces with larger ones. ``ids_crc32`` is the checksum of the ids as little-endian 32-bit numbers; without
    ``with_ids`` the ids themselves are left out and never leave the task that made them.

    Null and empty texts are the end id alone. Very long texts are cut into as many pieces as they need.
    Rows that repeat an id, or have none, are packed as rows of their own. An empty table gives no rows;
    other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule}")
    lean_batches(docs.sparkSession)
    cut = _pieces(docs, size, id_col, text_col, with_ids, with_ids, vocabulary, ranks)
    pieces, seen = stored_with(cut, "pieces", {"compression": "zstd"}, n=F.count("*"))
    places = place_pieces(pieces, seen["n"], size, documents, attention, rule, group_pieces)
    out = ["doc_id", "piece", "start", "length", "ids_crc32", *([_of_any_width()] if with_ids else []), "sequence_id", "offset"]
    return pieces.join(stored(places, "places"), "key").select(*out)
