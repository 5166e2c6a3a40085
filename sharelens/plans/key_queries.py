"""Key, rule and staging queries (P1-P5, P8-P13) on whole texts of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import normalize_label, normalize_text, split_title
from ..functions.rules import (
    LABEL_STRING_RULES,
    OWNER_RULES,
    PATH_OWNER_RULES,
    INDEPENDENT_OTHER,
    INDEPENDENT_UNKNOWN,
    label_string_group,
    owner_group,
    path_owner_group,
    resolve_group,
)
from ..operators.staging import in_groups, map_keys, rename
from .registry import register, table
from .sqlgen import case_sql, lit, normalize_label_sql, normalize_text_sql, split_title_sql


def chart_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A "type - user N" title per event; cheap events get no separator and
    expensive ones a second separator, so all three split cases occur."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value", "props")
    title = (F.when(F.col("value") < 10, F.col("event_type"))
             .otherwise(F.concat(F.col("event_type"), F.lit(" - user "), F.col("user_id").cast("string"),
                                 F.when(F.col("value") > 150, F.concat(F.lit(" - "), F.col("props")))
                                 .otherwise(F.lit("")))))
    return e.select("event_id", title.alias("artist_and_title"))


CHART_TITLES_SQL = """
  SELECT event_id,
         CASE WHEN value < 10 THEN event_type
              ELSE event_type || ' - user ' || CAST(user_id AS VARCHAR)
                   || CASE WHEN value > 150 THEN ' - ' || props ELSE '' END END AS artist_and_title
  FROM events"""

_A, _T = split_title_sql("artist_and_title")


@register("split_title", "P1", sql=f"""
SELECT event_id, {_A} AS artist_name, {_T} AS track_name FROM ({CHART_TITLES_SQL}) t""")
def q_split_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    artist, track = split_title("artist_and_title")
    return chart_titles(spark, sf_dir).select("event_id", artist.alias("artist_name"), track.alias("track_name"))


@register("normalize_text", "P2", sql=f"""
SELECT doc_id, {normalize_text_sql('text')} AS text_key FROM documents""")
def q_normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", normalize_text("text").alias("text_key"))


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    return (t("documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("text").alias("name"))
            .unionByName(t("part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"),
                                          F.concat_ws(" ", "p_name", "p_type").alias("name")))
            .unionByName(t("supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"),
                                              F.col("s_name").alias("name")))
            .unionByName(t("nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"),
                                            F.col("n_name").alias("name"))))


NAMES_SQL = """
  SELECT 'd' || CAST(doc_id AS VARCHAR) AS id, text AS name FROM documents
  UNION ALL SELECT 'p' || CAST(p_partkey AS VARCHAR), concat_ws(' ', p_name, p_type) FROM part
  UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), s_name FROM supplier
  UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), n_name FROM nation"""


@register("normalize_label", "P3", sql=f"""
SELECT id, {normalize_label_sql('name')} AS label_key FROM ({NAMES_SQL}) t""")
def q_normalize_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("id", normalize_label("name").alias("label_key"))


@register("classify_rules", "P8,P9,P10,P11", sql=f"""
WITH c AS (
  SELECT id,
         {case_sql('name', OWNER_RULES, INDEPENDENT_OTHER, INDEPENDENT_UNKNOWN)} AS owner_group,
         {case_sql('name', PATH_OWNER_RULES, INDEPENDENT_OTHER)} AS path_group,
         {case_sql('name', LABEL_STRING_RULES, None)} AS label_group
  FROM ({NAMES_SQL}) t)
SELECT id, owner_group, path_group, label_group,
       coalesce(label_group, owner_group, 'Independent / Unmapped') AS parent_group
FROM c""")
def q_classify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _names(spark, sf_dir).select(
        "id",
        owner_group("name").alias("owner_group"),
        path_owner_group("name").alias("path_group"),
        label_string_group("name").alias("label_group"),
    )
    return out.withColumn("parent_group", resolve_group("label_group", "owner_group"))


STATUS_MAP = {"F": "filled", "O": "open"}


@register("stage_select", "P4,P5,P12,P13", sql="""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_day,
       o_totalprice AS price,
       CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END AS status
FROM orders
WHERE o_orderpriority IS NOT NULL AND o_orderstatus IN ('F', 'O')""")
def q_stage_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    staged = (o.where(F.col("o_orderpriority").isNotNull() & in_groups("o_orderstatus", list(STATUS_MAP)))
              .withColumn("o_orderdate", F.to_date("o_orderdate"))
              .withColumn("o_orderstatus", map_keys("o_orderstatus", STATUS_MAP)))
    return rename(staged, {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderdate": "order_day",
                           "o_totalprice": "price", "o_orderstatus": "status"})
