"""Every registered query against its checking SQL, and the shape of the driver contract."""

import oracle
import pytest
from conftest import DATA

import __spark_entry__ as contract
from workloads.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(DATA)


def test_contract(spark):
    assert set(ORACLES) == set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    found, extra, missing = oracle.compare(
        connection, QUERIES[name](spark, DATA), ORACLES[name]
    )
    assert found > 0 and not extra and not missing
