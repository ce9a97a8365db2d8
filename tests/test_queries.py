"""Every registered query against its SQL check."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from tidegate.plans.checks import CHECKS as OWN_CHECKS
from tidegate.plans.queries import QUERIES as OWN_QUERIES

SF = "/root/testdata/sf0.001"
QUERIES = contract.queries()
CHECKS = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_a_check():
    assert OWN_QUERIES.keys() == OWN_CHECKS.keys()
    assert CHECKS.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_equals_check(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], CHECKS[name], SF) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.schema == contract.entry(spark).schema
