import pytest

from silsila.plans.registry import QUERIES, SQL

from .oracle import assert_equal, connect


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, data, con, name):
    assert_equal(QUERIES[name](spark, data), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, data, name):
    df = QUERIES[name](spark, data)
    assert df.count() >= 0 and len(df.columns) == len(set(df.columns))


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
