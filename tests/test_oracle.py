"""Every query beside its SQL; set ORACLE_SF for another scale."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_check import compare, duck

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n in queries() if n in SQL])
def test_matches_sql(spark, con, name):
    assert compare(spark, con, SF, queries()[name], SQL[name]) is None


@pytest.mark.parametrize("name", [n for n in queries() if n not in SQL and n != "pipeline" and not n.startswith("op")])
def test_runs_in_full(spark, name):
    """Queries without SQL: all their columns are worked out and written nowhere."""
    df = queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    rows = entry(spark).collect()
    assert {r["feature"] for r in rows if r["drifted"]} == {"error_mean"}
