"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as entry_points
from ontarmac.checks import compare

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return compare.sql_session(folder)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, con, name):
    assert compare.difference(QUERIES[name](spark, folder), con.sql(ORACLES[name]).to_arrow_table()) is None


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["route", "route_hist_delay_rate", "flights"]
