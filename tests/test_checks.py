"""Every registered query against its check SQL."""

import os

import pytest

import __spark_entry__
from scenetrail.plans import registry
from compare import check_rows, connect, difference, spark_rows

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, CHECKS = registry.all_queries(), registry.all_checks()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_check(spark, con, name):
    got = spark_rows(QUERIES[name](spark, SF_DIR))
    assert got[1], "no rows"
    assert name in CHECKS
    assert difference(got, check_rows(con, CHECKS[name])) is None


def test_entry(spark):
    assert "step_id" in __spark_entry__.entry(spark).columns
