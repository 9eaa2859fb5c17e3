"""Every query with SQL against DuckDB, the others for rows."""

import pytest
from oracle import connect, differences

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    result = queries()[name](spark, SF)
    if name in SQL:
        assert differences(result, duck, SQL[name]) == []
    else:
        assert result.count() > 0


def test_entry(spark):
    assert entry(spark).count() == 5
