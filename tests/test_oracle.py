"""Every registered query with SQL gives the rows that DuckDB gives."""

import pytest

import __spark_entry__ as contract
from workload.check import difference
from workload.queries import QUERIES


@pytest.mark.parametrize("name", [name for name, query in QUERIES.items() if query.sql])
def test_same_rows_as_sql(name, spark, sf_dir, base):
    assert difference(name, spark, sf_dir, base) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    flagship = contract.entry(spark)
    assert flagship.columns == ["feature", "corr", "abs_corr"]
    assert flagship.count() > 0
