"""Every registered query against its SQL, on the smallest given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, rows
from workload.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("LUMBUNG_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason=f"{SF_DIR} is not there")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    result = con.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    got = rows(df.columns, df.collect())
    assert got and got == rows(columns, result.fetchall())


def test_no_plan_has_python_workers_or_cartesian_products(spark):
    for name in (
        "staging_olah_aktivitas_belajar",
        "dim_kelas",
        "bridge_enrich_salted",
        "append_new_nullsafe",
        "scorecard",
        "domain_rule",
    ):
        df = contract.queries()[name](spark, SF_DIR)
        plan = df._jdf.queryExecution().executedPlan().toString()
        for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan, (name, word)
