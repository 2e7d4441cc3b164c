"""Every query with an SQL twin, all values, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect, type_notes
from tests.conftest import SMALL

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    assert compare(df, con, ORACLE[name]) is None
    assert type_notes(df, con, ORACLE[name]) == []
