"""Every query that has SQL gives what the SQL gives."""

import pytest

import __spark_entry__ as entry_points
from tests.oracle import connect, difference

ORACLES = entry_points.oracle_sql()
QUERIES = entry_points.queries()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, con, folder):
    assert difference(QUERIES[name](spark, folder), con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows_and_a_stable_schema(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["day", "field", "severity", "n"]
    assert frame.count() > 0
