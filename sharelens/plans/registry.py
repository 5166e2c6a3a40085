"""Registered queries: a Spark builder and, where SQL can say it, a DuckDB twin.

Each query reads the driver's tables (or frames Spark derives from them) from
``sf_dir``; the twin is ANSI SQL over the same tables registered as views.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str


QUERIES: dict[str, Query] = {}


def register(name: str, ids: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = Query(name, fn, sql, ids)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
