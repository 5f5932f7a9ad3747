"""Every registered query against its reference SQL, and the shape of its plan."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry
from check import bag
from ledgermill.catalog import load_queries
from tests.conftest import SF_DIR

QUERIES = {name: q.run for name, q in load_queries().items()}
ORACLES = {name: q.sql for name, q in load_queries().items() if q.sql is not None}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_reference(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in physical and "NestedLoop" not in physical
    assert "PythonUDF" not in plan and "MapInPandas" not in plan
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert bag(df.columns, df.collect()) == bag(columns, result.fetchall())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.schema == entry(spark).schema
