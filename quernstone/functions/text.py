"""Row-level text expressions. Every function maps Columns to a Column and stays in the JVM.

Two rules hold for all patterns here. Whitespace is the explicit Unicode class ``WS`` (Java's own
``\\s`` is ASCII only), and any pattern with a dot starts with ``(?d)`` so that only ``\\n`` ends a line.
Where possible whitespace is first mapped to plain spaces with ``translate``, which is several times
faster than a regex over the wide class.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 whitespace code points, as a regex class body and as plain characters.
WS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Documentation tags that end the useful part of a line.
DOC_TAGS = (
    ":param", ":type", ":return", ":rtype", "@param", "@return", "@throws",
    "Args:", "Returns:", "Raises:",
)
# The shorter tag list of the first-line variant.
FIRSTLINE_TAGS = (":param", ":type", ":return", ":rtype", "@param", "@return")

MIN_CODE_CHARS = 10
CODE_WORDS = (20, 250)
DOC_WORDS = (3, 50)


def strip_ws(text: Column) -> Column:
    """Remove whitespace from both ends."""
    return F.btrim(text, F.lit(WS_CHARS))


def split_words(text: Column) -> Column:
    """Whitespace-separated words as an array; an empty or blank text has none."""
    spaced = F.translate(text, WS_CHARS, " " * len(WS_CHARS))
    return F.array_remove(F.split(spaced, " "), "")


def collapse_ws(text: Column) -> Column:
    """Whitespace runs become one space, none at the ends."""
    return F.array_join(split_words(text), " ")


def remove_ws(text: Column) -> Column:
    return F.translate(text, WS_CHARS, "")


# --- summary side ----------------------------------------------------------------------------


def first_paragraph(doc: Column) -> Column:
    return F.substring_index(doc, "\n\n", 1)


def _drop_to_line_end(text: Column, markers: tuple[str, ...]) -> Column:
    return F.regexp_replace(text, f"(?d)(?:{'|'.join(markers)}).*", "")


def strip_doc_tags(doc: Column) -> Column:
    """Delete from a documentation tag, wherever it stands in the line, to the end of that line."""
    return _drop_to_line_end(doc, DOC_TAGS)


def strip_doctest(doc: Column) -> Column:
    return _drop_to_line_end(doc, (">>>",))


# Fixed value: web addresses, up to the next white space.
URL = f"http[^{WS}]+"


def strip_urls(doc: Column) -> Column:
    return F.regexp_replace(doc, URL, "")


def _has_any(text: Column, *marks: str) -> Column:
    found = text.contains(marks[0])
    for mark in marks[1:]:
        found = found | text.contains(mark)
    return found


def clean_docstring(doc: Column) -> Column:
    """First paragraph without tags, doctests and URLs, on one line; a null becomes empty.

    Every tag has a colon or an at sign, so most texts skip the three patterns.
    """
    head = first_paragraph(doc)
    marked = _has_any(doc, ":", "@", ">>>", "http")
    body = F.when(marked, strip_urls(strip_doctest(strip_doc_tags(head)))).otherwise(head)
    return F.coalesce(collapse_ws(body), F.lit(""))


def clean_docstring_firstline(doc: Column) -> Column:
    """The debug variant: first line only, fewer tags, URLs kept."""
    line = F.substring_index(first_paragraph(doc), "\n", 1)
    return F.coalesce(strip_ws(strip_doctest(_drop_to_line_end(line, FIRSTLINE_TAGS))), F.lit(""))


# Triple-quoted blocks, and one-line string literals or comments.
TRIPLE_QUOTED = r"""(?:\"{3}[\s\S]*?\"{3}|'{3}[\s\S]*?'{3})"""
STRING_OR_COMMENT = r"""(?d)(".*?(?<!\\)"|'.*?(?<!\\)')|#.*"""

# --- source side -----------------------------------------------------------------------------


def strip_first_docstring(code: Column) -> Column:
    """Remove the first triple-quoted block of either quote kind, and only that one."""
    return F.array_join(F.split(code, TRIPLE_QUOTED, 2), "")


def strip_comments(code: Column) -> Column:
    """Delete ``#`` comments; a ``#`` inside a one-line string literal survives.

    The string alternatives come first, so a literal is consumed (and put back) before any ``#``
    within it can start a comment.
    """
    return F.regexp_replace(code, STRING_OR_COMMENT, "$1")


def drop_blank_lines(code: Column) -> Column:
    """Drop whitespace-only lines and trim both ends of the whole text.

    Between two line ends with nothing but whitespace there are only blank lines, so one
    substitution removes any run of them; blank lines at either end fall to the final trim.
    """
    return strip_ws(F.regexp_replace(code, f"\\n[{WS}]*\\n", "\n"))


def clean_code(code: Column) -> Column:
    """Source without its first docstring, comments and blank lines; a null becomes empty.

    Without a ``#`` there is no comment to delete, and without a triple quote no docstring.
    """
    body = strip_first_docstring(code)
    kept = F.when(code.contains("#"), strip_comments(body)).when(_has_any(code, '"""', "'''"), body).otherwise(code)
    return F.coalesce(drop_blank_lines(kept), F.lit(""))


# --- gates -----------------------------------------------------------------------------------


def word_count(text: Column) -> Column:
    return F.size(split_words(text))


def has_alnum(text: Column) -> Column:
    return text.rlike(r"[\p{L}\p{N}]")


def min_chars(code: Column, limit: int = MIN_CODE_CHARS) -> Column:
    return F.length(code) >= limit


def length_band(
    code_words: Column,
    doc_words: Column,
    code_band: tuple[int, int] = CODE_WORDS,
    doc_band: tuple[int, int] = DOC_WORDS,
) -> Column:
    """Both word counts within their inclusive bounds."""
    return code_words.between(*code_band) & doc_words.between(*doc_band)


def fingerprint(code: Column) -> Column:
    """MD5 over the text without any whitespace, so layout does not matter."""
    return F.md5(remove_ws(code))


def debug_filter(doc_line: Column, raw_code: Column) -> Column:
    """The loose gate of the debug preview: a doc above 10 characters, code below 200 words."""
    return (F.length(doc_line) > 10) & (word_count(raw_code) < 200)


# --- rendering -------------------------------------------------------------------------------


def detok_cleanup(text: Column) -> Column:
    """Turn word-start marks into spaces, halve double spaces once, trim."""
    spaced = F.replace(text, F.lit("Ġ"), F.lit(" "))
    return strip_ws(F.replace(spaced, F.lit("  "), F.lit(" ")))


def audit_code(code: Column, width: int = 60) -> Column:
    """One-line excerpt for audit reports."""
    flat = F.replace(strip_ws(code), F.lit("\n"), F.lit(" "))
    return F.concat(F.substring(flat, 1, width), F.lit("..."))


def audit_line(code: Column, doc: Column) -> Column:
    return F.struct(audit_code(code).alias("code_line"), strip_ws(doc).alias("doc_line"))
