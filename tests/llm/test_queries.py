"""The registered queries against their SQL texts."""

import duckdb
import pytest

from endpulse.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    frame, want = QUERIES[name](spark, SF_DIR), duck.sql(ORACLES[name])
    columns = sorted(frame.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
    assert got == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)


def test_all_thirteen_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
