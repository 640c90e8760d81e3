"""Every registered query equals its SQL on the smallest test tables."""

import oracle_check
import pytest

import __spark_entry__ as registered
from batchloom.registry.oracle import ORACLE
from batchloom.registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    assert oracle_check.differences(result, duck, ORACLE[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) <= set(registered.queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry_has_rows(spark):
    assert registered.entry(spark).count() > 0
