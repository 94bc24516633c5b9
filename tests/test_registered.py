"""Every registered query equals its SQL counterpart on the smallest given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import SCALES, connect, of_spark, of_sql
from millrace.plans import oracle
from millrace.plans import queries as registry

FOLDER = f"{SCALES}/sf0.001"
QUERIES = registry.registered()
STATEMENTS = oracle.statements()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_equals_sql(spark, con, name):
    columns, rows = of_spark(QUERIES[name](spark, FOLDER))
    expected_columns, expected = of_sql(con, STATEMENTS[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_every_query_has_sql():
    assert set(STATEMENTS) == set(QUERIES)


def test_contract_holds_them():
    assert QUERIES.keys() <= contract.queries().keys()
    assert STATEMENTS.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert contract.entry(spark).count() == 10
