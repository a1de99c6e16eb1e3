"""Token-level expressions: byte-level pre-tokens and wrapped id arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Control tokens and their ids.
PAD, SOS, EOS, UNK = 0, 1, 2, 3
SPECIAL_TOKENS = ("<PAD>", "<SOS>", "<EOS>", "<UNK>")
MAX_CODE_IDS, MAX_DOC_IDS = 256, 64

# Unicode White_Space, and the published byte-level splitting pattern over it.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def _byte_alphabet() -> tuple[str, str]:
    """Bytes without a glyph of their own, and the stand-ins that follow U+0100 in byte order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in printable]
    return "".join(map(chr, hidden)), "".join(chr(0x100 + i) for i in range(len(hidden)))


def pretokenize(text: Column) -> Column:
    """Raw pre-tokens of a text, spaces attached to the word they precede."""
    return F.regexp_extract_all(text, F.lit(PRETOKEN), F.lit(0))


def byte_level(token: Column) -> Column:
    """UTF-8 bytes of a text as one visible character each.

    Reading the bytes as Latin-1 gives one character per byte; the unprintable ones are swapped.
    """
    hidden, shown = _byte_alphabet()
    latin = F.decode(F.encode(token, "UTF-8"), "ISO-8859-1")
    return F.translate(latin, hidden, shown)


def wrap_ids(ids: Column, max_len: int) -> Column:
    """``[SOS] + ids + [EOS]``, the middle cut so that the whole has at most ``max_len``."""
    body = F.slice(ids, 1, max_len - 2)
    return F.concat(F.array(F.lit(SOS)), body, F.array(F.lit(EOS)))
