"""Queries of the subpackage that SQL can express have the rows that DuckDB gives."""

import pytest

from compare import difference
from duelframe.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, name):
    assert difference(spark, "/root/testdata/sf0.001", registry.queries()[name], registry.oracle_sql()[name]) == ""
