"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SMALL
from tools.check_oracles import NO_SQL, compare, connect


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_queries_without_sql_are_known():
    missing = set(queries()) - set(oracle_sql())
    assert {q for q in missing if not q.startswith("op")} <= NO_SQL


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, duck, name):
    text, _, ok = compare(spark, duck, SMALL, name, queries()[name], oracle_sql().get(name))
    assert ok, text
