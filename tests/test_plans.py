"""Plan-shape guards: no cross or nested-loop joins, pruned scans, pushed filters."""

from __future__ import annotations

import re

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry

from .conftest import SF_SMALL

def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_daily_share_scans_pruned(spark):
    df = entry.queries()["daily_share"](spark, SF_SMALL)
    plan = _plan(df)
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", _formatted(spark, df))
    assert "struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in schemas
    assert all("o_orderpriority" not in s and "c_acctbal" not in s for s in schemas)
    assert plan.count("HashAggregate") >= 2          # partial + final aggregation


def test_metadata_size_filter_reaches_scan(spark):
    text = _formatted(spark, entry.queries()["link_tracks"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(p_size,40", text)
    assert "WindowGroupLimit" in text                 # W1 keeps one row per key before the shuffle


def test_missing_keys_aggregates_both_sides_before_the_join(spark):
    plan = entry.queries()["missing_keys"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    top = plan.index("Join LeftOuter")
    assert plan[top:].count("Aggregate [") >= 2


def test_quantiles_do_not_join_on_the_group_alone(spark):
    plan = entry.queries()["series_describe"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert all("_pid" in line or "event_type" in line for line in plan.splitlines() if "Join Inner" in line)
    assert sum("Join Inner" in line for line in plan.splitlines()) == 1


def test_ordered_union_is_ordered(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    want = con.execute(entry.oracle_sql()["ordered_union"]).fetchall()
    assert [tuple(r) for r in entry.queries()["ordered_union"](spark, SF_SMALL).collect()] == want


def test_strict_links_count_every_chart_row(spark):
    fact = entry.queries()["link_strict"](spark, SF_SMALL)
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").join(part, F.col("l_partkey") == F.col("p_partkey"))
    assert fact.agg(F.sum("row_count")).first()[0] == lines.count()
    assert fact.agg(F.sum("total_streams")).first()[0] == lines.agg(F.sum(F.floor("l_quantity"))).first()[0]
