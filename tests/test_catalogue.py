"""Every query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import TABLES_DIR, connect, differences
from isobar.plans.catalogue import QUERIES
from isobar.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def duck():
    return connect()


def test_each_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLE.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_matches(name, spark, duck):
    result = contract.queries()[name](spark, TABLES_DIR)
    assert differences(result, duck, contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).columns[:3] == ["grain", "city", "datetime"]
