"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import differences, duck
from conftest import SF_DIR
from ledgerweave.plans.catalog import QUERIES
from ledgerweave.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    found = differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name])
    assert found is None, found
