"""Every registered query with SQL gives the same rows as the SQL, on the smallest tables."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(contract._QUERIES) == set(contract._ORACLES)


@pytest.mark.parametrize("name", sorted(contract._ORACLES))
def test_same_rows(spark, con, name):
    rows, wanted, differ, schema = compare(
        contract.queries()[name](spark, SF), con, contract._ORACLES[name]
    )
    assert (rows, differ, schema) == (wanted, 0, "")


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["event_type", "window_id", "window_end", "prediction"]
    assert result.count() == 15
