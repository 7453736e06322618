"""Every registered query against its SQL, and what keeps them large-scale."""

import pytest

import __spark_entry__ as entry
from hubloom.plans.oracle import ORACLE_SQL
from hubloom.plans.queries import QUERIES
from oracle_check import differences, oracle_connection


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, connection, name):
    frame = QUERIES[name](spark, sf_dir)
    assert differences(frame, connection, ORACLE_SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "deployment_id", "n_tasks", "n_with_options", "executable"]
