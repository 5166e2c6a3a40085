"""End-to-end signal query (E3) and the streaming form of the daily fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from ..operators.series import align_calendars, calendar_difference, pivot_wide, rolling_features
from ..operators.share import daily_share
from ..operators.stats import corr_matrix, lead_lag, pearson_significance
from ..session import cut_lineage, scratch_path
from ..sources.tables import write_partitions
from ..streaming.incremental import run_to_end, stream_daily_fact
from .registry import register, table
from .series_queries import (
    _PRICED,
    COMBINED_SQL,
    FLAG_TO_SEGMENT,
    PRICE_RETURNS_SQL,
    PVALUE_SQL,
    SEGMENT_SHARE_SQL,
    _corr_sql,
    _lead_lag_sql,
    _r,
    combined,
    price_returns,
    rolling_sql,
    share_series,
)
from .sqlgen import share_sql


_PRICED_SHARE_SQL = f"SELECT * FROM ({SEGMENT_SHARE_SQL}) a WHERE segment IN ({_PRICED})"


@register("e2e_signals", "E3,P12,A7,A8,W4,W5,W6,W7,W8,J6", sql=f"""
WITH g AS ({rolling_sql(_PRICED_SHARE_SQL)}),
r AS ({PRICE_RETURNS_SQL}),
k AS (SELECT DISTINCT order_day FROM g INTERSECT SELECT DISTINCT order_day FROM r),
cal AS (SELECT order_day, row_number() OVER (ORDER BY order_day) AS cal_idx FROM k),
f AS (SELECT COALESCE(g.segment, r.segment) AS segment, COALESCE(g.order_day, r.order_day) AS order_day,
             g.market_share_pct, g.ma7, g.roc7, g.zscore, r.log_return
      FROM (SELECT * FROM g WHERE order_day IN (SELECT order_day FROM k)) g
      FULL OUTER JOIN (SELECT * FROM r WHERE order_day IN (SELECT order_day FROM k)) r
        ON g.segment = r.segment AND g.order_day = r.order_day)
SELECT f.segment, f.order_day, ROUND(market_share_pct, 6) AS market_share_pct, ROUND(ma7, 6) AS ma7,
       ROUND(roc7, 6) AS roc7, ROUND(zscore, 6) AS zscore, ROUND(log_return, 6) AS log_return,
       ROUND(market_share_pct - FIRST_VALUE(market_share_pct) OVER (PARTITION BY f.segment ORDER BY cal.cal_idx
             RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING), 6) AS ms_change
FROM f JOIN cal ON cal.order_day = f.order_day""")
def q_e2e_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced share series -> rolling momentum features on their own union
    calendar -> aligned with price returns on the common calendar (the wide
    inner join) -> share change over that calendar."""
    feats = rolling_features(share_series(spark, sf_dir), "segment", "order_day", "market_share_pct", window=7)
    j = align_calendars(feats.select("segment", "order_day", "market_share_pct", "ma7", "roc7", "zscore"),
                        price_returns(spark, sf_dir), "segment", "order_day")
    return _r(calendar_difference(j, "segment", "order_day", "market_share_pct", out="ms_change"))


_SEGMENTS = sorted(FLAG_TO_SEGMENT.values())
_SIGNALS = [f"{s.lower()}_{kind}" for kind in ("change", "return") for s in _SEGMENTS]
_WIDE_SQL = "SELECT order_day, " + ", ".join(
    f"MAX(CASE WHEN segment = '{s}' THEN {col} END) AS {s.lower()}_{kind}"
    for kind, col in (("change", "ms_change"), ("return", "log_return")) for s in _SEGMENTS
) + f" FROM ({COMBINED_SQL}) c GROUP BY order_day"


@register("e2e_signals_corr", "E3,A9,A10,W9", sql=f"""
WITH w AS MATERIALIZED ({_WIDE_SQL}),
m AS ({" UNION ALL ".join(f"SELECT '{a}' AS series_a, '{b}' AS series_b, {_corr_sql(a, b)} AS v FROM w" for a in _SIGNALS for b in _SIGNALS)})
SELECT 'matrix' AS step, series_a, series_b, CAST(NULL AS INTEGER) AS lag, CAST(NULL AS BIGINT) AS n, ROUND(v, 6) AS value,
       CAST(NULL AS DOUBLE) AS p_value FROM m
UNION ALL
SELECT 'test', lower(segment) || '_change', lower(segment) || '_return', NULL, n, ROUND(r, 6), ROUND(p_value, 6)
FROM ({PVALUE_SQL}) p
UNION ALL
SELECT 'lag', lower(segment) || '_change', lower(segment) || '_return', lag, n_pairs, correlation, NULL
FROM ({_lead_lag_sql()}) l""")
def q_e2e_signals_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain from the share fact: changes and returns on the common
    calendar -> matrix of all six (missing days stay NULL, so pairs are
    deleted pairwise), significance of each change with its return, lag profile."""
    c = cut_lineage(combined(spark, sf_dir))
    pivots = [pivot_wide(c, "order_day", "segment", col, _SEGMENTS, {s: f"{s.lower()}_{kind}" for s in _SEGMENTS})
              for kind, col in (("change", "ms_change"), ("return", "log_return"))]
    matrix = corr_matrix(pivots[0].join(pivots[1], "order_day"), _SIGNALS, out="value")
    names = [F.concat(F.lower("segment"), F.lit(f"_{kind}")).alias(f"series_{x}") for x, kind in (("a", "change"), ("b", "return"))]
    none = lambda kind: F.lit(None).cast(kind)
    test = pearson_significance(c, ["segment"], "ms_change", "log_return")
    lag = lead_lag(c, c, "segment", "order_day", "ms_change", "log_return", max_lag=10)
    rows = (matrix.select(F.lit("matrix").alias("step"), "series_a", "series_b", none("int").alias("lag"), none("bigint").alias("n"),
                          "value", none("double").alias("p_value"))
            .unionByName(test.select(F.lit("test").alias("step"), *names, none("int").alias("lag"), "n", F.col("r").alias("value"), "p_value"))
            .unionByName(lag.select(F.lit("lag").alias("step"), *names, "lag", F.col("n_pairs").alias("n"),
                                    F.col("correlation").alias("value"), none("double").alias("p_value"))))
    return _r(rows)


EVENT_CHART_SCHEMA = StructType([
    StructField("event_type", StringType()), StructField("user_id", LongType()),
    StructField("value", DoubleType()), StructField("chart_date", DateType()),
])


@register("stream_share", "S1,S9 (stream)", sql=f"""
SELECT chart_date, event_type AS parent_group, total_streams, track_count, row_count,
       {share_sql('total_streams', 'chart_date')} AS market_share_pct
FROM (SELECT CAST(ts AS DATE) AS chart_date, event_type, CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS total_streams,
             COUNT(DISTINCT user_id) AS track_count, COUNT(*) AS row_count
      FROM events GROUP BY 1, 2) a""")
def q_stream_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land as daily files; an availableNow stream (a few files per
    micro-batch) keeps the day x type share fact up to date."""
    src, out = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-fact")
    e = table(spark, sf_dir, "events").select("event_type", "user_id", "value", F.to_date("ts").alias("chart_date"))
    write_partitions(e, src)

    def build(rows: DataFrame) -> DataFrame:
        cents = rows.select("chart_date", F.col("event_type").alias("parent_group"), "user_id",
                            F.round(F.col("value") * 100).cast("bigint").alias("cents"))
        return daily_share(cents, "chart_date", "parent_group", "cents", "user_id")

    run_to_end(stream_daily_fact(spark, src, EVENT_CHART_SCHEMA, build, out, max_files_per_trigger=8))
    return spark.read.parquet(out)
