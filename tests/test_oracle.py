"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import ENTRY_DIR, entry
from tallyhouse.plans.oracle import oracle_sql
from tallyhouse.plans.registry import queries
from tests.oracle_check import connect, has_order, problems


@pytest.fixture(scope="module")
def db(small):
    return connect(small)


def test_every_query_has_sql():
    assert queries().keys() == oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, small, db, name):
    found, _ = problems(queries()[name](spark, small), oracle_sql()[name], db)
    assert not found


def test_entry(spark):
    assert ENTRY_DIR
    assert entry(spark).count() == 10


def test_ordered_answers_are_compared_in_order(spark, db):
    known = oracle_sql()
    assert {n for n in known if has_order(known[n])} >= {"top_customers", "running_total", "monthly_growth", "pct_of_category"}
    rows = spark.createDataFrame([(2,), (1,)], "n bigint")
    assert problems(rows, "SELECT * FROM (VALUES (1::BIGINT), (2::BIGINT)) AS t(n) ORDER BY n", db)[0]
    assert not problems(rows, "SELECT * FROM (VALUES (1::BIGINT), (2::BIGINT)) AS t(n)", db)[0]
    assert not problems(rows, "SELECT * FROM (VALUES (1::BIGINT), (2::BIGINT)) AS t(n) ORDER BY n DESC LIMIT 5", db)[0]
