"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import checks.all  # noqa: F401
from checks.base import QUERIES, SQL
from checks.compare import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    if name in SQL:
        assert difference(spark, connection, FOLDER, name) is None
    else:
        assert QUERIES[name](spark, FOLDER).columns


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
