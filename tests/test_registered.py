from __future__ import annotations

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_DIR
from workload.registry import QUERIES


@pytest.fixture(scope="module")
def connection():
    return check.open_tables(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, connection, name):
    assert check.compare(spark, connection, SF_DIR, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).columns == ["PMID", "Title", "Year"]
