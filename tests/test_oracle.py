"""Every registered query equals its SQL twin."""

import pytest

import __spark_entry__ as entry
from gaugeline.plans.oracle import ORACLE
from gaugeline.plans.queries import QUERIES
from oracle_check import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_equal(spark, con, name):
    ok, note = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
