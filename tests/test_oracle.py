"""Every query against its SQL statement on a second engine."""

import pytest
from compare import differences, sql_engine
from conftest import SF

from assetops.catalog import QUERIES
from oracle.queries import ORACLE

@pytest.fixture(scope="module")
def engine():
    return sql_engine(SF)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, engine, name):
    assert differences(QUERIES[name](spark, SF), engine, ORACLE[name]) == []
