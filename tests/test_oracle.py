"""Every registered query against its oracle statement, on the smallest test data."""

from __future__ import annotations

import pytest
from compare import differences
from conftest import SF_DIR

import __spark_entry__ as contract
from oracle import oracle_queries
from wardmart.plans.registry import QUERIES as WAREHOUSE

QUERIES = {name: contract.queries()[name] for name in WAREHOUSE}
ORACLE = oracle_queries()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, oracle, name):
    assert differences(QUERIES[name](spark, SF_DIR), oracle, ORACLE[name]) == []


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
