"""Every registered query against its checking SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import duck, mismatch

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, connection, name):
    assert mismatch(entry.queries()[name], entry.oracle_sql().get(name), spark, SF_DIR, connection) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
