"""Registered queries of this part against their check SQL on the smallest driver tables, and that all are there."""

import pytest

import __spark_entry__ as entry_point
from check import compare, connect
from fieldtally.llm.queries import CHECKS, QUERIES

DIR = "/root/testdata/sf0.001"


def test_one_query_an_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= entry_point.queries().keys() and CHECKS.items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, name):
    assert compare(connect(DIR), CHECKS[name], QUERIES[name](spark, DIR)) == ""
