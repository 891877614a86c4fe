"""Every query that has SQL, compared on the smallest tables."""

import pytest

from check import connect, difference
from conftest import SF_SMALL
from ebbtide.catalog import QUERIES
from ebbtide.oracle import ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, con, name):
    assert difference(spark, con, SF_SMALL, QUERIES[name], ORACLES[name]) is None


def test_entry_runs(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
