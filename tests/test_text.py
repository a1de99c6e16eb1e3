"""Row-level expressions against small Python restatements of their rules."""

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quernstone.functions import text as T
from tests.plain import plain_code, plain_doc

SPACES = T.WS_CHARS


def evaluate(spark, texts, **makers):
    columns = {n: make(F.col("x")) for n, make in makers.items()}
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    rows = frame.select("i", *[c.alias(n) for n, c in columns.items()]).orderBy("i").collect()
    return [r if len(columns) > 1 else r[1] for r in rows]


DOCS = [
    None, "", "\n\nstarts empty", "Plain summary.", "Use httpd and http here", "see http://a.b/c?d now",
    "Do it.\n\nMore.", "Sum :param x: y\nnext", "x Args: a\n>>> f()\nrest", "a\r\n\r\nb", "word@return gone",
    "tab\tand wide\x1cspaces　end ", "line sep >>> cut",
]
CODES = [
    None, "", "x = 1  # c", 'a = "x#y"  # z', '"a\\"b#c" # d', '"\\\\" # x', 'x = "\\\\" # "y"', "it's # a\nb = 'c'",
    '"""one"""\nx\n"""two"""', "'''a'''\n\"\"\"b\"\"\"", "   first\n\n  \t \nlast   ", "# only\n\n", "a # b c\nd",
    "def f():\n    '''doc\n    more'''\n    return 1", "x\r\n\r\ny", '"open # not closed\nb # c',
]


def test_known_docs(spark):
    assert evaluate(spark, DOCS, c=T.clean_docstring) == [plain_doc(d) for d in DOCS]


def test_known_codes(spark):
    assert evaluate(spark, CODES, c=T.clean_code) == [plain_code(c) for c in CODES]


PIECES = st.sampled_from(
    ["a", "bc", " ", "\n", "\n\n", "#", '"', "'", "\\", '"""', "'''", ":param", "Args:", ">>>", "http", "http://x",
     "\t", " ", "\x1c", "\x85", " ", "é", "9", "\r\n"]
)
TEXTS = st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=60, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=TEXTS)
def test_random_texts(spark, texts):
    got = evaluate(
        spark, texts, doc=T.clean_docstring, code=T.clean_code, words=T.word_count, flat=T.collapse_ws,
        ends=T.strip_ws, fp=T.fingerprint, alnum=T.has_alnum,
    )
    for text, row in zip(texts, got):
        assert row.doc == plain_doc(text)
        assert row.code == plain_code(text)
        assert row.words == len(text.split())
        assert row.flat == " ".join(text.split())
        assert row.ends == text.strip()
        assert row.fp == hashlib.md5("".join(text.split()).encode()).hexdigest()
        assert row.alnum == any(c.isalnum() for c in text)


def test_every_whitespace_character(spark):
    assert len(set(SPACES)) == 29 and all(c.isspace() for c in SPACES)
    texts = [f"a{c}b" for c in SPACES]
    rows = evaluate(spark, texts, n=T.word_count, flat=T.collapse_ws, url=lambda x: T.strip_urls(F.concat(F.lit("http"), x)))
    assert all(r.n == 2 and r.flat == "a b" for r in rows)
    assert [r.url for r in rows] == [f"{c}b" for c in SPACES]


@pytest.mark.parametrize("words, inside", [((19, 3), False), ((20, 3), True), ((250, 50), True), ((251, 50), False),
                                           ((20, 2), False), ((20, 51), False)])
def test_band_edges(spark, words, inside):
    band = T.length_band(F.lit(words[0]), F.lit(words[1]))
    assert spark.range(1).select(band).first()[0] is inside


def test_firstline_variant(spark):
    docs = ["One http://x line\nsecond", "A :param b\n\nc", "Raises: stays", "  >>> gone", None]
    assert evaluate(spark, docs, c=T.clean_docstring_firstline) == ["One http://x line", "A", "Raises: stays", "", ""]


def test_rendering(spark):
    assert evaluate(spark, ["Ġab ĠĠc", "a    b"], c=T.detok_cleanup) == ["ab  c", "a  b"]
    assert evaluate(spark, [" a\nb ", "x" * 80], c=T.audit_code) == ["a b...", "x" * 60 + "..."]
