"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from storeledger.workload import oracles, queries
from tests.oracle import connect, differences

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(queries.registry())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tables, name):
    assert differences(queries.registry()[name](spark, SF), tables, SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
