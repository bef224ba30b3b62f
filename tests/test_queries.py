"""Every query against its SQL statement, on the smallest tables."""

import __spark_entry__ as entry
import pytest
from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == ""


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert [r["yr"] for r in rows] == list(range(1995, 2001))
    assert rows[0]["total_volume_change"] is None
