"""Byte-level BPE ids of whole texts, with word pieces looked up in bulk."""

from __future__ import annotations

import base64
from collections.abc import Sequence
from functools import cached_property, lru_cache

import numpy as np

from quernstone.llm.common import CHUNK_BYTES, slice_hashes

# The public tokenizer's files, its special text, and the id that ends a document.
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = "<|endoftext|>"
END_ID = 2
KNOWN_LIMIT = 500_000
# Bytes that can follow a blank at the start of a piece. Left out are ASCII control and white space and
# the lead bytes of wider white space, where a cut could fall inside a run of blanks.
_STARTS = np.zeros(256, dtype=bool)
_STARTS[33:127] = True
_STARTS[0xC3:0xF5] = True
_STARTS[[0xE1, 0xE2, 0xE3]] = False


class Encoder:
    """Ids of texts, equal to the public tokenizer's, special tokens added by none but the text itself.

    A blank before a visible character always starts a new piece, so texts are cut there and each
    distinct piece of a batch is encoded once. Pieces are told apart by length and a 64-bit hash.
    What earlier batches have met is kept, up to ``KNOWN_LIMIT`` pieces.
    """

    def __init__(self, vocabulary: str | None = None, ranks: str | None = None):
        import public_tokenizers
        import tiktoken

        self.vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
        with open(ranks or public_tokenizers.path(RANKS), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.bytes_of = np.zeros(max(table.values()) + 1, dtype=np.int64)
        for piece, number in table.items():
            self.bytes_of[number] = len(piece)
        self._forget()

    @cached_property
    def whole(self):
        """The public tokenizer itself, for texts that spell a special token."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.vocabulary)

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.place = np.empty(0, np.int64)
        self.count = np.empty(0, np.int64)
        self.pool = np.empty(1 << 16, np.uint32)
        self.used = 0

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        out, counts, held, size = [], [], [], 0

        def flush() -> None:
            nonlocal size
            if held:
                ids, n = self._pieces(held)
                out.append(ids)
                counts.append(n)
                held.clear()
                size = 0

        for text in texts:
            if SPECIAL in text:
                flush()
                ids = np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
                out.append(ids)
                counts.append(np.array([len(ids)]))
                continue
            raw = text.encode("utf-8", "replace")
            held.append(raw)
            size += len(raw)
            if size >= CHUNK_BYTES:
                flush()
        flush()
        return np.concatenate([np.empty(0, np.uint32), *out]), np.concatenate([np.empty(0, np.int64), *counts]).astype(np.int64)

    def _pieces(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        joined = b"".join(texts)
        data = np.frombuffer(joined, dtype=np.uint8)
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(texts), dtype=np.int64)
        first = np.cumsum(sizes) - sizes
        cut = np.zeros(len(data), dtype=bool)
        cut[:-1] = (data[:-1] == 32) & _STARTS[data[1:]]
        cut[first[sizes > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        hashes = slice_hashes(data, starts, ends)
        own, back = np.unique(hashes, return_inverse=True)
        self._learn(joined, own, back, starts, ends)
        at = np.searchsorted(self.known, own)[back]
        n = self.count[at]
        total = np.cumsum(n)
        index = np.repeat(self.place[at] - (total - n), n) + np.arange(total[-1])
        ids = self.pool[index]
        per_text = np.zeros(len(texts), dtype=np.int64)
        owner = np.searchsorted(first, starts, side="right") - 1
        np.add.at(per_text, owner, n)
        return ids, per_text

    def _learn(self, joined: bytes, own: np.ndarray, back: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode the pieces that are not known yet, those that start with a blank in one go."""
        if len(self.known) > KNOWN_LIMIT:
            self._forget()
        at = np.minimum(np.searchsorted(self.known, own), max(len(self.known) - 1, 0))
        new = np.flatnonzero(self.known[at] != own) if len(self.known) else np.arange(len(own))
        if not len(new):
            return
        example = np.empty(len(own), dtype=np.int64)
        example[back] = np.arange(len(back))
        some = example[new]
        blank = np.frombuffer(joined, dtype=np.uint8)[starts[some]] == 32
        blank &= _STARTS[np.frombuffer(joined, dtype=np.uint8)[np.minimum(starts[some] + 1, len(joined) - 1)]]
        hashes, runs, lengths = [], [], []
        if blank.any():
            s, e = starts[some[blank]], ends[some[blank]]
            text = b"".join([joined[a:b] for a, b in zip(s.tolist(), e.tolist())]).decode("utf-8")
            ids = self.fast.encode_to_numpy(text).astype(np.uint32)
            reached = np.concatenate([[0], np.cumsum(self.bytes_of[ids])])
            upto = np.searchsorted(reached, np.cumsum(e - s))
            hashes.append(own[new[blank]])
            runs.append(ids)
            lengths.append(np.diff(upto, prepend=0))
        for number, piece in zip(new[~blank].tolist(), some[~blank].tolist()):
            ids = np.array(self.fast.encode_ordinary(joined[starts[piece] : ends[piece]].decode("utf-8")), dtype=np.uint32)
            hashes.append(own[number : number + 1])
            runs.append(ids)
            lengths.append(np.array([len(ids)]))
        ids, n = np.concatenate(runs), np.concatenate(lengths).astype(np.int64)
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.empty(max(len(self.pool), 2 * len(ids)), np.uint32)])
        self.pool[self.used : self.used + len(ids)] = ids
        known = np.concatenate([self.known, *hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.place = np.concatenate([self.place, self.used + np.cumsum(n) - n])[order]
        self.count = np.concatenate([self.count, n])[order]
        self.used += len(ids)


@lru_cache(maxsize=1)
def shared_encoder(vocabulary: str | None = None, ranks: str | None = None) -> Encoder:
    """One encoder per Python worker, with what its earlier tasks have learned."""
    return Encoder(vocabulary, ranks)
