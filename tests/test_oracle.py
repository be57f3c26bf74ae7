"""Every registered query against its SQL, over whole tables."""

import pytest
from oracle_check import assert_same, duck

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(name == "pipeline" or name.startswith("op") for name in without)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert_same(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 177
