"""Every registered query against its SQL oracle on the smallest tables."""

import os

import pytest

from oracle import REGISTRY, compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    count, differences = compare(spark, con, FOLDER, name)
    assert not differences, differences
    assert count > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names
    assert entry.entry(spark).count() > 0
