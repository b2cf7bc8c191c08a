"""Every registered query equals its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks import compare

@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare.compare(spark, con, sf_dir, entry.queries()[name], entry.oracle_sql()[name]).startswith("ok")
