"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from conftest import SMALL

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) in ("", "EMPTY")
    else:
        assert df.count() >= 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
