"""Driver contract and every registered query against its DuckDB twin (sf0.001)."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from sharelens.plans.registry import TABLES
from tools.check_oracle import digest, type_diff

from .conftest import SF_SMALL


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_date", "region", "total_streams", "track_count", "row_count", "market_share_pct"]


def test_contract_keys():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 40
    assert all(callable(f) for f in q.values())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_twin(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.columns
        return
    rel = duck.execute(sql)
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert not type_diff(df.dtypes, duck, sql)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
