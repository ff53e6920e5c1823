"""Every catalog query with an SQL twin, held against DuckDB on the smallest tables."""

import pytest

from filmloom import catalog_queries
from tests.oracle import connection, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(catalog_queries.oracle_sql()))
def test_equals_sql(spark, con, name):
    df = catalog_queries.queries()[name](spark, SF)
    assert not differences(df, con, catalog_queries.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalog_queries.queries()) - set(catalog_queries.oracle_sql())))
def test_runs(spark, name):
    assert catalog_queries.queries()[name](spark, SF).count() >= 0
