"""Every query with an SQL twin gives the same rows, names, types and values."""

import check
import pytest

import __spark_entry__ as entry
from conftest import SF


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    result = check.compare(spark, duck, name, SF)
    assert result.startswith("ok") and "TYPES" not in result, result


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 250
    assert "total_annual_cost" in df.columns
