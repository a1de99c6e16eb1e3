"""Every registered query at the smallest scale, against its SQL where it has one."""

import pytest

import __spark_entry__ as entry
from checks import catalog, oracle
from checks.compare import compare

SMALL = "/root/testdata/sf0.001"
QUERIES = {name: entry.queries()[name] for name in catalog.queries()}
SQL = oracle.build()


def test_every_statement_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"train_bpe", "encode_bpe", "vocab_table"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    result = compare(spark, name, QUERIES[name], SQL.get(name), SMALL)
    assert result["ok"] and "differ" not in result["note"], result


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["id", "split", "code", "docstring"] and rows.count() > 0
