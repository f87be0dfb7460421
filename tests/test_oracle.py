"""Every registered query with a SQL twin: Spark result == DuckDB result on
the sf0.001 tables (the driver's gate runs the same at sf0.01)."""

import os

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.check_oracle import compare, duck

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql_twin(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.sql(SQL[name]).df()
    assert compare(got, want) == "OK"


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")
def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "churned" in df.columns and "user_id" in df.columns
