"""Every registered query against its DuckDB oracle on the smallest data."""
import pytest

import __spark_entry__ as entry_point
from dwspark.plans import registry as E
from dwspark.oracle.compare import compare, duck_connection

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), con, SQL[name])
    assert ok, msg


def test_entry_runs(spark):
    rows = entry_point.entry(spark).collect()
    assert len(rows) > 0 and set(rows[0].asDict()) == {"category", "T1", "T2", "T3", "T4", "total"}
