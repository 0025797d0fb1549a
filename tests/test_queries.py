"""Every registered query against its SQL statement in DuckDB."""

import pytest

import __spark_entry__ as driver
import compare
from compare import SMALL
from workload.oracle import oracle_sql
from workload.queries import QUERIES

SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


def test_every_statement_belongs_to_a_query():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    if name in SQL:
        assert compare.difference(df, duck, SQL[name]) is None
    else:
        assert df.count() > 0
