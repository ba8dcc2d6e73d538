"""Every query with a SQL text gives the same rows as that text on the whole tables."""

import pytest

from oracle_compare import differences, duck

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_rows(spark, con, sf_dir, name, few):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == []


def test_every_text_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()
