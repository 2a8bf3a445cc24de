"""Every query against plain SQL on the smallest scale."""

import pytest

import __spark_entry__ as contract
from barsmith.plans.oracles import ORACLES
from barsmith.plans.queries import QUERIES

from .compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert differences(contract.queries()[name](spark, SF), duck, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    assert set(QUERIES) == set(ORACLES)
    names = set(contract.queries())
    assert set(QUERIES) <= names and set(contract.oracle_sql()) <= names
