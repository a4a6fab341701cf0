"""The corpus queries against their SQL on the smallest tables, and the registry's names."""

import pytest

from tallyhouse.llm import queries, sql
from tests.oracle_check import connect, problems


@pytest.fixture(scope="module")
def db(small):
    return connect(small)


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))
    assert sql.oracle_sql().keys() <= queries.queries().keys()


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_equals_sql(spark, small, db, name):
    found, rows = problems(queries.queries()[name](spark, small), sql.oracle_sql()[name], db)
    assert rows and not found
