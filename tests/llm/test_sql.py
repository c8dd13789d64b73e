"""The text queries that SQL can express, against SQL on the same tables."""

import pytest
from compare import differences, duck

from gridtide.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_result(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), SQL[name], duck(sf_dir)) == []
