"""Every query with a SQL oracle returns the oracle's rows."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import difference, oracle_connection

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return oracle_connection(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())


def test_entry(spark):
    shown = entry(spark)
    assert shown.count() == 20
    assert "trend_label" in shown.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf, con, name):
    got = queries()[name](spark, sf).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert difference(got, want) == ""
