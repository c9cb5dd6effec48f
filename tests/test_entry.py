"""The registered queries on the smallest data set: against their SQL, and their plans."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as driver

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert len(driver.QUERIES) >= 64
    assert driver.QUERIES.keys() <= driver.oracle_sql().keys()


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return ""
    if isinstance(value, (bool, str)):
        return str(value)
    return repr(float(value))


@pytest.mark.parametrize("name", sorted(driver.QUERIES))
def test_matches_sql(spark, duck, name):
    result = driver.queries()[name](spark, str(DATA))
    plan = result._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF",
                "MapInPandas"):
        assert bad not in plan
    columns = sorted(result.columns)
    relation = duck.sql(driver.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    names = ", ".join(f'"{c}"' for c in columns)
    wanted = sorted(tuple(map(plain, row)) for row in relation.project(names).fetchall())
    found = sorted(tuple(map(plain, row)) for row in result.select(*columns).collect())
    assert found == wanted
