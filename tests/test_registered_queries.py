"""Every registered query against its check SQL on the smallest driver tables."""

import pytest

import __spark_entry__ as entry_point
from check import compare, connect
from fieldtally.driver import CHECKS, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(DIR)


def test_every_query_has_a_check():
    assert QUERIES.keys() == CHECKS.keys()
    assert QUERIES.items() <= entry_point.queries().items() and CHECKS.items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(con, CHECKS[name], QUERIES[name](spark, DIR)) == ""


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert "category_label" in frame.columns and frame.count() > 0
