"""The corpus queries that have SQL against it, on the smallest tables."""

import os

import pytest
from compare import compare, duck

from pagequarry.llm import checks

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")


@pytest.mark.parametrize("name", checks.SQL)
def test_rows_equal_the_sql(spark, name):
    equal, _, message = compare(spark, duck(SMALL), SMALL, name, checks.QUERIES[name], checks.SQL[name])
    assert equal, message
