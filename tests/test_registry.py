"""Every registered query against plain SQL over the same files."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from breakwater.plans import registry
from tests import oracle

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    from tests.conftest import SF_DIR

    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf_dir, connection, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), connection, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_query_is_registered():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
