"""Queries of the subpackage against their SQL, and the names that must exist."""

import pytest
from compare import differences, sql_engine

from assetops.llm.queries import QUERIES
from assetops.llm.sql import ORACLE

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, name):
    assert differences(QUERIES[name](spark, SF), sql_engine(SF), ORACLE[name]) == []
