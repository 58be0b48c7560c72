import pytest

from cohortloom.plans.registry import QUERIES, SQL
from oracle import compare, connection


@pytest.fixture(scope="module")
def con(small):
    return connection(small)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, small, con, name):
    compare(QUERIES[name](spark, small), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    df = QUERIES[name](spark, small)
    assert df.columns and (df.count() > 0 or name == "ref_t08_population_mention")  # no document of the small table restricts its population
