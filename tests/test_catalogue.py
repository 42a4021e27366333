"""Every catalogue query against its SQL statement on the smallest benchmark tables."""

from __future__ import annotations

import os

import pytest

from kerbflow.catalogue import all_queries
from tests.comparing import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables absent")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_sql(spark, con, name):
    query = all_queries()[name]
    assert query.sql is not None
    assert compare(query.build(spark, SF_DIR), con, query.sql) is None


def test_entry_points(spark):
    import __spark_entry__ as entry_points

    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).columns
