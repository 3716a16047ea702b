"""Every registered query against its SQL text, or for rows where SQL cannot say it."""

import pytest

import __spark_entry__ as entry

from .oracle import compare, duck

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, folder, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES.get(name), folder) == ""


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_oracles_name_queries():
    assert set(ORACLES) <= set(QUERIES)
