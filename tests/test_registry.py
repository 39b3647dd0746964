"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as contract
from checks import queries as registry
from checks.compare import difference, open_tables

NAMES = [key for key in contract.queries() if key in contract.oracle_sql()]


@pytest.fixture(scope="module")
def tables(sf_dir):
    return open_tables(sf_dir)


@pytest.mark.parametrize("key", NAMES)
def test_same_as_oracle(spark, tables, sf_dir, key):
    assert difference(spark, tables, sf_dir, key) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) == set(NAMES) >= set(registry.queries())
    assert contract.entry(spark).count() == 6
