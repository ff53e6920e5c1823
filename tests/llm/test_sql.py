import pytest

from filmloom.llm import registry
from tests.oracle import connection, differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_sql(spark, name):
    assert not differences(registry.QUERIES[name](spark, SF), connection(SF), registry.SQL[name])
