"""Sets of word shingles as sorted 64-bit hashes, for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

from quernstone.llm.common import CHUNK_BYTES, mix64, slice_hashes

WORDS = 5
# Blank, tab, line feed, vertical tab, form feed, carriage return.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_FACTORS = [0x9FB21C651E98DF25, 0xD1B54A32D192ED03, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3]


def _factor(k: int) -> np.uint64:
    return np.uint64((_FACTORS[k % len(_FACTORS)] + 2 * k) & ((1 << 64) - 1))


def shingle_sets(texts: Sequence[str | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted, distinct shingle hashes of each text.

    A-Z count as lower case; words are parted by blanks and the five ASCII white-space controls. A text
    of fewer words is one shingle of all of them; null or blank texts have none.
    """
    held, size = [], 0
    for text in texts:
        raw = b"" if text is None else text.encode("utf-8", "replace")
        held.append(raw)
        size += len(raw)
        if size >= CHUNK_BYTES:
            yield from _sets(held, words)
            held, size = [], 0
    if held:
        yield from _sets(held, words)


def _sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    visible = np.zeros(len(data) + 1, dtype=np.int8)
    visible[1:] = ~_BLANK[data]
    edge = np.diff(visible)
    starts = np.flatnonzero(edge == 1)
    ends = np.flatnonzero(edge == -1)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    first_word = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
    hashes = slice_hashes(data, starts, ends)
    count = max(len(hashes) - words + 1, 0)
    rolled = np.zeros(count, dtype=np.uint64)
    for k in range(words):
        rolled += hashes[k : k + count] * _factor(k)
    rolled = mix64(rolled)
    for a, b in zip(first_word[:-1].tolist(), first_word[1:].tolist()):
        if b - a >= words:
            yield np.unique(rolled[a : b - words + 1])
        elif b > a:
            whole = sum((int(h) * int(_factor(k)) for k, h in enumerate(hashes[a:b])), b - a) & ((1 << 64) - 1)
            yield mix64(np.array([whole], dtype=np.uint64))
        else:
            yield np.empty(0, dtype=np.uint64)
