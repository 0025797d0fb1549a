"""Registered queries against their DuckDB statements, and the driver's contract."""

import compare
import pytest

import __spark_entry__ as driver
from snapledger.llm.oracles import SQL
from snapledger.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


def test_one_query_per_operator():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(driver.queries())
    assert set(SQL) <= set(QUERIES) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_statement(spark, duck, name):
    assert compare.difference(QUERIES[name](spark, SMALL), duck, SQL[name]) is None
