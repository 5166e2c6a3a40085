"""Share queries on the driver's star schema: orders by day x region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.share import daily_share, share_table, total_by_group
from .registry import register, table
from .sqlgen import share_sql


def order_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: day, region name, whole-unit price, customer.

    orders -> customer is the big equi-join (shuffle on custkey, AQE decides);
    nation and region are fixed 25/5-row dimensions that the planner
    broadcasts by its size threshold.
    """
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
           .join(region, nation.n_regionkey == region.r_regionkey)
           .select("c_custkey", "r_name"))
    return (orders.join(geo, orders.o_custkey == geo.c_custkey)
            .select(F.to_date("o_orderdate").alias("order_date"),
                    F.col("r_name").alias("region"),
                    F.floor("o_totalprice").alias("volume"),
                    F.col("o_custkey")))


ORDER_VOLUME_SQL = """
  SELECT CAST(o.o_orderdate AS DATE) AS order_date, r.r_name AS region,
         CAST(FLOOR(o.o_totalprice) AS BIGINT) AS volume, o.o_custkey
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey"""


@register("daily_share", "A1,W3", sql=f"""
WITH base AS ({ORDER_VOLUME_SQL}),
agg AS (
  SELECT order_date, region, CAST(SUM(volume) AS BIGINT) AS total_streams,
         COUNT(DISTINCT o_custkey) AS track_count, COUNT(*) AS row_count
  FROM base GROUP BY order_date, region)
SELECT order_date, region, total_streams, track_count, row_count,
       {share_sql('total_streams', 'order_date')} AS market_share_pct
FROM agg""")
def q_daily_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a share of integer totals is one IEEE division: bit-equal to the twin without rounding
    return daily_share(order_volume(spark, sf_dir), "order_date", "region", "volume", "o_custkey")


@register("total_by_group", "A3", sql=f"""
WITH base AS ({ORDER_VOLUME_SQL})
SELECT region, CAST(SUM(volume) AS BIGINT) AS total FROM base GROUP BY region""")
def q_total_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_by_group(order_volume(spark, sf_dir), "region", "volume")


@register("share_rollup", "A4", sql=f"""
WITH base AS ({ORDER_VOLUME_SQL}),
g AS (SELECT NULLIF(region, 'AFRICA') AS region, CAST(SUM(volume) AS BIGINT) AS total FROM base GROUP BY 1),
r AS (SELECT region, total, 'group' AS row_kind FROM g
      UNION ALL
      SELECT 'ASIA', CAST(SUM(total) AS BIGINT), 'subtotal' FROM g WHERE region IN ('AMERICA', 'EUROPE'))
SELECT region, total, row_kind, total::DOUBLE / (SELECT SUM(total) FROM g) AS share_pct
FROM r""")
def q_share_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One region is NULL and the subtotal is named like another one: both stay groups of their own."""
    volume = order_volume(spark, sf_dir).withColumn("region", F.nullif("region", F.lit("AFRICA")))
    return share_table(volume, "region", "volume", ["AMERICA", "EUROPE"], "ASIA")
