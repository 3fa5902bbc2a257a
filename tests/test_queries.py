"""Every registered query against its SQL text, and what its plan may not hold."""

import duckdb
import pytest

import __spark_entry__ as entry
from workload import fixtures
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in fixtures.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows),
                  key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    want = duck.sql(ORACLES[name])
    assert sorted(frame.columns) == sorted(want.columns)
    assert rows_of(frame.columns, map(tuple, frame.collect())) == rows_of(want.columns, want.fetchall())
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_filters_and_columns_reach_the_scan(spark):
    from endpulse.operators import select
    from workload.queries import QUERIES as q

    plan = q["expire_dead"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan
    plan = q["status_counts"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint>" in plan
    plan = q["split_payload_links"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "html" not in plan
