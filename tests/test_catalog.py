"""Every registered query against its SQL, and its plan."""

import duckdb
import pytest

import __spark_entry__ as entry
from oracle import differences, duck

# The optional subpackage has tests of its own.
QUERIES, ORACLES = entry.QUERIES, entry.ORACLES


@pytest.fixture(scope="module")
def con(folder):
    with duck(folder) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(name, spark, folder, con: duckdb.DuckDBPyConnection):
    df = QUERIES[name](spark, folder)
    assert differences(df, con, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert costly not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["q_id", "n", "text"]
    assert df.where("n = 3").count() == 40
