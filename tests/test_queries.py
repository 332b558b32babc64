"""Every registered query against its SQL, and the shape of its plan."""

import duckdb
import pytest

import check
from __spark_entry__ import entry
from oracles.sql import all_oracles as oracle_sql
from residua.plans.queries import all_queries as queries

NAMES = list(queries())


@pytest.fixture(scope="module")
def con(folder):
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def oracles():
    return oracle_sql()


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, con, folder, oracles, name):
    verdict, _ = check.compare(spark, con, folder, name, oracles.get(name))
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_and_no_python_worker(spark, folder, name):
    plan = queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "InArrow"):
        assert word not in plan, word


def test_every_query_has_sql(oracles):
    assert set(oracles) == set(NAMES)


def test_entry_is_the_leaderboard(spark):
    assert [r["place"] for r in entry(spark).collect()] == [1, 2, 3, 4, 5, 6]
