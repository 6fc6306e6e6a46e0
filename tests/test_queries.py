"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, differences
from conftest import SF_DIR

import __spark_entry__ as contract
from quittance.plans.oracle import oracle_queries
from quittance.plans.queries import QUERIES

SQL = oracle_queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, SQL[name]) == []


def test_all_are_registered():
    assert QUERIES.items() <= contract.queries().items()
    assert SQL.items() <= contract.oracle_sql().items()
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
