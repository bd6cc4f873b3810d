"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, got, want, note = compare(spark, con, FOLDER, QUERIES[name], SQL.get(name))
    assert ok is not False, f"{got} rows against {want}: {note}"


def test_entry(spark):
    assert entry(spark).count() > 0
