"""Series, signal and statistics queries.

Stand-ins: the share series is each market segment's daily share of order
volume (most days miss a segment, like a label missing from a day's chart);
the price series is the mean unit price per return flag and ship day, with
flags mapped to segments by name (the reference's ticker -> label key map).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import round_binary
from ..operators.quantiles import describe
from ..operators.series import (
    align_calendars,
    calendar_difference,
    date_join,
    latest_k,
    log_returns,
    pivot_wide,
    rolling_features,
    series_profile,
)
from ..operators.share import daily_share
from ..operators.staging import in_groups, map_keys
from ..operators.stats import corr_matrix, corr_matrix_long, lead_lag, pearson_by_group, pearson_significance
from .registry import register, table
from .sqlgen import share_sql

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
# price series key -> share series key, matched by name
FLAG_TO_SEGMENT = {"A": "AUTOMOBILE", "N": "MACHINERY", "R": "BUILDING"}
FLAG_NAMES = {"A": "accepted", "N": "pending", "R": "returned"}


def _r(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (hash-stable comparison with the twin)."""
    return df.select(*[round_binary(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# ---------------------------------------------------------------- stand-in series
def segment_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(segment, order_day, market_share_pct, total_volume) from orders x customer."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    rows = o.join(c, o.o_custkey == c.c_custkey).select(
        F.to_date("o_orderdate").alias("order_day"), F.col("c_mktsegment").alias("segment"),
        F.floor("o_totalprice").alias("volume"))
    share = daily_share(rows, "order_day", "segment", "volume")
    return share.select("segment", "order_day", F.col("total_streams").alias("total_volume"), "market_share_pct")


SEGMENT_SHARE_SQL = f"""
  SELECT segment, order_day, total_volume,
         {share_sql('total_volume', 'order_day')} AS market_share_pct
  FROM (SELECT c.c_mktsegment AS segment, CAST(o.o_orderdate AS DATE) AS order_day,
               CAST(SUM(FLOOR(o.o_totalprice)) AS BIGINT) AS total_volume
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        GROUP BY 1, 2) a"""


def flag_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(flag, ship_day, price): mean unit price per return flag and ship day."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_shipdate", "l_extendedprice", "l_quantity")
    return (li.groupBy(F.col("l_returnflag").alias("flag"), F.to_date("l_shipdate").alias("ship_day"))
            .agg(F.avg(F.try_divide("l_extendedprice", "l_quantity")).alias("price")))


FLAG_PRICE_SQL = """
  SELECT l_returnflag AS flag, CAST(l_shipdate AS DATE) AS ship_day,
         AVG(CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END) AS price
  FROM lineitem GROUP BY 1, 2"""


def event_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    return (e.groupBy(F.col("event_type"), F.to_date("ts").alias("day"))
            .agg(F.sum("value").alias("total_value")))


EVENT_DAILY_SQL = """
  SELECT event_type, CAST(ts AS DATE) AS day, SUM(value) AS total_value FROM events GROUP BY 1, 2"""


def price_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(segment, date, log_return): flags mapped to segments, returns on the
    union calendar of the price series."""
    p = flag_price(spark, sf_dir)
    r = log_returns(p, "flag", "ship_day", "price")
    return r.select(map_keys("flag", FLAG_TO_SEGMENT).alias("segment"),
                    F.col("ship_day").alias("order_day"), "log_return")


PRICE_RETURNS_SQL = f"""
  SELECT CASE flag WHEN 'A' THEN 'AUTOMOBILE' WHEN 'N' THEN 'MACHINERY' WHEN 'R' THEN 'BUILDING' END AS segment,
         ship_day AS order_day,
         CASE WHEN prev > 0 AND price / prev > 0 THEN ln(price / prev) END AS log_return
  FROM (SELECT p.*, FIRST_VALUE(price) OVER (PARTITION BY flag ORDER BY cal_idx
                                             RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS prev
        FROM ({FLAG_PRICE_SQL}) p
        JOIN (SELECT ship_day, row_number() OVER (ORDER BY ship_day) AS cal_idx
              FROM (SELECT DISTINCT ship_day FROM ({FLAG_PRICE_SQL}) q) d) c USING (ship_day)) x"""


def share_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share series of the groups that have a price series (P12 IN-list,
    as the reference keeps only the priced groups before pivoting)."""
    s = segment_share(spark, sf_dir).select("segment", "order_day", "market_share_pct")
    return s.where(in_groups("segment", sorted(FLAG_TO_SEGMENT.values())))


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share series and returns aligned on the common calendar (J6 on wide
    frames) with the share change over that calendar (W8)."""
    j = align_calendars(share_series(spark, sf_dir), price_returns(spark, sf_dir), "segment", "order_day")
    return calendar_difference(j, "segment", "order_day", "market_share_pct", out="ms_change")


_PRICED = ", ".join(f"'{v}'" for v in sorted(FLAG_TO_SEGMENT.values()))

COMBINED_SQL = f"""
  SELECT f.segment, f.order_day, f.market_share_pct, f.log_return,
         f.market_share_pct - FIRST_VALUE(f.market_share_pct) OVER (PARTITION BY f.segment ORDER BY cal.cal_idx
             RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS ms_change
  FROM (SELECT COALESCE(s.segment, r.segment) AS segment, COALESCE(s.order_day, r.order_day) AS order_day,
               s.market_share_pct, r.log_return
        FROM (SELECT segment, order_day, market_share_pct FROM ({SEGMENT_SHARE_SQL}) a
              WHERE segment IN ({_PRICED})
                AND order_day IN (SELECT order_day FROM ({PRICE_RETURNS_SQL}) q)) s
        FULL OUTER JOIN
             (SELECT segment, order_day, log_return FROM ({PRICE_RETURNS_SQL}) b
              WHERE order_day IN (SELECT order_day FROM ({SEGMENT_SHARE_SQL}) c WHERE segment IN ({_PRICED}))) r
          ON s.segment = r.segment AND s.order_day = r.order_day) f
  JOIN (SELECT order_day, row_number() OVER (ORDER BY order_day) AS cal_idx
        FROM (SELECT DISTINCT order_day FROM ({SEGMENT_SHARE_SQL}) d WHERE segment IN ({_PRICED})
              INTERSECT SELECT DISTINCT order_day FROM ({PRICE_RETURNS_SQL}) e) k) cal
    ON cal.order_day = f.order_day"""


# ---------------------------------------------------------------- queries
@register("series_profile", "A5", sql="""
SELECT event_type, COUNT(*) AS n_rows, MIN(CAST(ts AS DATE)) AS first_date, MAX(CAST(ts AS DATE)) AS last_date
FROM events GROUP BY event_type""")
def q_series_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"))
    return series_profile(e, "event_type", "day")


@register("series_describe", "A6", sql="""
SELECT event_type, COUNT(x) AS count, ROUND(AVG(x), 6) AS mean, ROUND(STDDEV_SAMP(x), 6) AS std,
       ROUND(MIN(x), 6) AS min, ROUND(quantile_cont(x, 0.25), 6) AS p25, ROUND(quantile_cont(x, 0.5), 6) AS p50,
       ROUND(quantile_cont(x, 0.75), 6) AS p75, ROUND(MAX(x), 6) AS max
FROM (SELECT event_type, value * 100 AS x FROM events) e GROUP BY event_type""")
def q_series_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return _r(describe(e, "event_type", "value", scale=100.0))


@register("pivot_share", "A7", sql=f"""
SELECT day, {', '.join(f"ROUND(MAX(CASE WHEN event_type = '{t}' THEN share END), 6) AS {t}" for t in EVENT_TYPES)}
FROM (SELECT event_type, day, {share_sql('total_value', 'day')} AS share
      FROM ({EVENT_DAILY_SQL}) d) s
GROUP BY day""")
def q_pivot_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_type", "value")
    share = daily_share(e, "day", "event_type", "value", names={"share": "share"})
    return _r(pivot_wide(share, "day", "event_type", "share", EVENT_TYPES))


@register("pivot_price", "A8", sql=f"""
SELECT ship_day, {', '.join(f"ROUND(MAX(CASE WHEN flag = '{k}' THEN price END), 6) AS {v}" for k, v in FLAG_NAMES.items())}
FROM ({FLAG_PRICE_SQL}) p GROUP BY ship_day""")
def q_pivot_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(pivot_wide(flag_price(spark, sf_dir), "ship_day", "flag", "price", list(FLAG_NAMES), FLAG_NAMES))


def rolling_sql(series_sql: str) -> str:
    return f"""
WITH s AS ({series_sql}),
cal AS (SELECT order_day, row_number() OVER (ORDER BY order_day) AS cal_idx FROM (SELECT DISTINCT order_day FROM s) d),
x AS (SELECT s.*, cal.cal_idx FROM s JOIN cal USING (order_day)),
f AS (
  SELECT segment, order_day, total_volume, market_share_pct,
         COUNT(market_share_pct) OVER w7 AS n7, AVG(market_share_pct) OVER w7 AS m7, STDDEV_SAMP(market_share_pct) OVER w7 AS s7,
         LAST_VALUE(market_share_pct IGNORE NULLS) OVER (PARTITION BY segment ORDER BY cal_idx
             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS now_v,
         LAST_VALUE(market_share_pct IGNORE NULLS) OVER (PARTITION BY segment ORDER BY cal_idx
             RANGE BETWEEN UNBOUNDED PRECEDING AND 7 PRECEDING) AS then_v
  FROM x
  WINDOW w7 AS (PARTITION BY segment ORDER BY cal_idx RANGE BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT segment, order_day, total_volume, market_share_pct,
       CASE WHEN n7 = 7 THEN m7 END AS ma7,
       CASE WHEN then_v <> 0 THEN now_v / then_v - 1 END AS roc7,
       CASE WHEN n7 = 7 AND s7 <> 0 THEN (market_share_pct - m7) / s7 END AS zscore
FROM f"""


ROLLING_SQL = rolling_sql(SEGMENT_SHARE_SQL)


@register("rolling_signals", "W4,W5,W6", sql=f"""
SELECT segment, order_day, total_volume, ROUND(market_share_pct, 6) AS market_share_pct,
       ROUND(ma7, 6) AS ma7, ROUND(roc7, 6) AS roc7, ROUND(zscore, 6) AS zscore,
       CAST(sign(zscore) AS DOUBLE) AS zscore_sign
FROM ({ROLLING_SQL}) g""")
def q_rolling_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = segment_share(spark, sf_dir)
    return _r(rolling_features(s, "segment", "order_day", "market_share_pct", window=7))


@register("log_returns", "W7", sql=f"""
SELECT segment, order_day, ROUND(log_return, 6) AS log_return FROM ({PRICE_RETURNS_SQL}) r""")
def q_log_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(price_returns(spark, sf_dir))


@register("latest_k", "W10", sql=f"""
SELECT segment, order_day, ROUND(market_share_pct, 4) AS market_share_pct
FROM ({SEGMENT_SHARE_SQL}) s
WHERE order_day IN (SELECT DISTINCT order_day FROM ({SEGMENT_SHARE_SQL}) t ORDER BY order_day DESC LIMIT 5)""")
def q_latest_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = segment_share(spark, sf_dir).select("segment", "order_day", "market_share_pct")
    return _r(latest_k(s, "segment", "order_day", 5), 4)


@register("date_join", "J6,J7", sql=f"""
SELECT s.segment, s.order_day, ROUND(s.market_share_pct, 6) AS market_share_pct, ROUND(r.log_return, 6) AS log_return
FROM ({SEGMENT_SHARE_SQL}) s JOIN ({PRICE_RETURNS_SQL}) r
  ON s.segment = r.segment AND s.order_day = r.order_day
WHERE s.market_share_pct IS NOT NULL AND r.log_return IS NOT NULL""")
def q_date_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = date_join(segment_share(spark, sf_dir).select("segment", "order_day", "market_share_pct"),
                  price_returns(spark, sf_dir), ["segment", "order_day"])
    return _r(j.where(F.col("market_share_pct").isNotNull() & F.col("log_return").isNotNull()))


@register("date_join_ffill", "J6 (forward fill)", sql=f"""
WITH s AS (SELECT segment, order_day, market_share_pct FROM ({SEGMENT_SHARE_SQL}) a),
r AS (SELECT segment, order_day, log_return FROM ({PRICE_RETURNS_SQL}) b),
u AS (SELECT segment, order_day, market_share_pct FROM s
      UNION ALL SELECT segment, order_day, NULL FROM r WHERE (segment, order_day) NOT IN (SELECT segment, order_day FROM s)),
f AS (SELECT segment, order_day, LAST_VALUE(market_share_pct IGNORE NULLS) OVER (PARTITION BY segment ORDER BY order_day
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS market_share_pct FROM u)
SELECT segment, order_day, ROUND(market_share_pct, 6) AS market_share_pct, ROUND(log_return, 6) AS log_return
FROM r JOIN f USING (segment, order_day)""")
def q_date_join_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns joined with the last share known on their day."""
    return _r(date_join(segment_share(spark, sf_dir).select("segment", "order_day", "market_share_pct"), price_returns(spark, sf_dir),
                        ["segment", "order_day"], ffill=True, date_col="order_day", fill_cols=["market_share_pct"]))


@register("rolling_sliced", "W4,W5,W6 (slices)", sql=f"""
SELECT segment, order_day, total_volume, ROUND(market_share_pct, 6) AS market_share_pct,
       ROUND(ma7, 6) AS ma7, ROUND(roc7, 6) AS roc7, ROUND(zscore, 6) AS zscore,
       CAST(sign(zscore) AS DOUBLE) AS zscore_sign
FROM ({ROLLING_SQL}) g""")
def q_rolling_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rolling signals with each series cut into slices of 100 positions."""
    return _r(rolling_features(segment_share(spark, sf_dir), "segment", "order_day", "market_share_pct", window=7, slice_positions=100))


@register("share_diff", "W8", sql=f"""
SELECT segment, order_day, ROUND(market_share_pct, 6) AS market_share_pct, ROUND(log_return, 6) AS log_return,
       ROUND(ms_change, 6) AS ms_change
FROM ({COMBINED_SQL}) c""")
def q_share_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(combined(spark, sf_dir))


def _corr_sql(a: str, b: str) -> str:
    pa = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {a} END"
    pb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {b} END"
    return (f"CASE WHEN STDDEV_SAMP({pa}) * STDDEV_SAMP({pb}) <> 0 "
            f"THEN COVAR_SAMP({pa}, {pb}) / (STDDEV_SAMP({pa}) * STDDEV_SAMP({pb})) END")


_CM_W = "SELECT day, " + ", ".join(
    f"MAX(CASE WHEN event_type = '{t}' THEN total_value END) AS {t}" for t in EVENT_TYPES
) + f" FROM ({EVENT_DAILY_SQL}) d GROUP BY day"


@register("corr_matrix", "A9", sql=f"""
WITH w AS ({_CM_W})
{" UNION ALL ".join(f"SELECT '{a}' AS series_a, '{b}' AS series_b, ROUND(({_corr_sql(a, b)}), 6) AS corr FROM w"
                    for a in EVENT_TYPES for b in EVENT_TYPES)}""")
def q_corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = pivot_wide(event_daily(spark, sf_dir), "day", "event_type", "total_value", EVENT_TYPES)
    return _r(corr_matrix(wide, EVENT_TYPES))


@register("corr_matrix_long", "A9 (many series)", sql=f"""
WITH m AS (SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, AVG(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
s AS (SELECT DISTINCT l_suppkey FROM m),
p AS (SELECT a.l_suppkey AS x, b.l_suppkey AS y, {_corr_sql('a.v', 'b.v')} AS r FROM m a JOIN m b ON a.month = b.month GROUP BY 1, 2)
SELECT a.l_suppkey AS series_a, b.l_suppkey AS series_b, ROUND(r, 6) AS corr
FROM s a CROSS JOIN s b LEFT JOIN p ON x = a.l_suppkey AND y = b.l_suppkey""")
def q_corr_matrix_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' monthly mean quantities, every supplier against every other, without a pivot."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity")
    monthly = li.groupBy("l_suppkey", F.trunc("l_shipdate", "month").alias("month")).agg(F.avg("l_quantity").alias("v"))
    return _r(corr_matrix_long(monthly, "l_suppkey", "month", "v"))


_PAIR = ("CASE WHEN ms_change IS NOT NULL AND log_return IS NOT NULL THEN {} END")


@register("corr_significance", "A10", sql=f"""
SELECT segment, n, ROUND(r, 6) AS r,
       ROUND(CASE WHEN n > 2 AND 1 - r * r <> 0 THEN r * sqrt((n - 2)::DOUBLE / (1 - r * r)) END, 6) AS t
FROM (SELECT segment, COUNT({_PAIR.format(1)}) AS n, {_corr_sql('ms_change', 'log_return')} AS r
      FROM ({COMBINED_SQL}) c GROUP BY segment) a""")
def q_corr_significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r(pearson_by_group(combined(spark, sf_dir), ["segment"], "ms_change", "log_return"))


# the distribution of t with an integer number of degrees of freedom as a sum of gamma-function terms
PVALUE_SQL = f"""
  SELECT segment, n, r, CASE WHEN n > 2 AND 1 - r * r <> 0 THEN r * sqrt((n - 2)::DOUBLE / (1 - r * r)) END AS t,
         CASE WHEN r IS NULL OR n < 2 THEN NULL WHEN n = 2 THEN 1.0 WHEN abs(r) >= 1 THEN 0.0
              WHEN n % 2 = 0 THEN greatest(0.0, 1 - abs(r) * total / sqrt(pi()))
              ELSE greatest(0.0, 1 - 2 / pi() * (asin(abs(r)) + abs(r) * sqrt(1 - r * r) * COALESCE(total, 0) * sqrt(pi()) / 2)) END
           AS p_value
  FROM (SELECT segment, COUNT({_PAIR.format(1)}) AS n, {_corr_sql('ms_change', 'log_return')} AS r
        FROM ({COMBINED_SQL}) c GROUP BY segment) a
  LEFT JOIN (
    SELECT segment, SUM(exp(k * ln(1 - r * r) + CASE WHEN n % 2 = 0 THEN lgamma(k + 0.5) - lgamma(k + 1.0)
                                                     ELSE lgamma(k + 1.0) - lgamma(k + 1.5) END)) AS total
    FROM (SELECT segment, n, r, unnest(range(0, (n - 2) // 2)) AS k
          FROM (SELECT segment, COUNT({_PAIR.format(1)}) AS n, {_corr_sql('ms_change', 'log_return')} AS r
                FROM ({COMBINED_SQL}) c GROUP BY segment) b WHERE n > 2 AND abs(r) < 1) t GROUP BY segment) s
  USING (segment)"""


@register("corr_pvalue", "A10", sql=f"""
SELECT segment, n, ROUND(r, 6) AS r, ROUND(t, 6) AS t, ROUND(p_value, 6) AS p_value, p_value < 0.05 AS significant
FROM ({PVALUE_SQL}) p""")
def q_corr_pvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """r, n, t, two-sided p-value and 5 % flag."""
    return _r(pearson_significance(combined(spark, sf_dir), ["segment"], "ms_change", "log_return"))


def _lead_lag_sql(max_lag: int = 10) -> str:
    return f"""
WITH c AS MATERIALIZED ({COMBINED_SQL}),
s AS MATERIALIZED (SELECT segment, order_day, ms_change AS v,
                          row_number() OVER (PARTITION BY segment ORDER BY order_day) AS pos
                   FROM c WHERE ms_change IS NOT NULL),
t AS MATERIALIZED (SELECT segment, order_day, log_return AS v,
                          row_number() OVER (PARTITION BY segment ORDER BY order_day) AS pos
                   FROM c WHERE log_return IS NOT NULL),
lags AS (SELECT range AS lag FROM range(-{max_lag}, {max_lag + 1})),
s0 AS MATERIALIZED (SELECT s.segment, l.lag, s.pos + GREATEST(l.lag, 0) AS at_pos, s.v FROM s CROSS JOIN lags l),
t0 AS MATERIALIZED (SELECT t.segment, l.lag, t.pos + GREATEST(-l.lag, 0) AS at_pos, t.v FROM t CROSS JOIN lags l),
sm AS MATERIALIZED (SELECT s0.segment, s0.lag, d.order_day, s0.v FROM s0 JOIN s d
                    ON d.segment = s0.segment AND d.pos = s0.at_pos),
tm AS MATERIALIZED (SELECT t0.segment, t0.lag, d.order_day, t0.v FROM t0 JOIN t d
                    ON d.segment = t0.segment AND d.pos = t0.at_pos),
p AS (SELECT sm.segment, sm.lag, sm.v AS x, tm.v AS y FROM sm JOIN tm
      ON sm.segment = tm.segment AND sm.lag = tm.lag AND sm.order_day = tm.order_day)
SELECT segment, CAST(lag AS INTEGER) AS lag, COUNT(*) AS n_pairs,
       ROUND(CASE WHEN STDDEV_SAMP(x) * STDDEV_SAMP(y) <> 0 THEN COVAR_SAMP(x, y) / (STDDEV_SAMP(x) * STDDEV_SAMP(y)) END, 6)
         AS correlation
FROM p GROUP BY segment, lag"""


@register("lead_lag", "W9", sql=_lead_lag_sql())
def q_lead_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = combined(spark, sf_dir)
    return _r(lead_lag(c, c, "segment", "order_day", "ms_change", "log_return", max_lag=10))


@register("ordered_union", "O1,O3,O4", sql="""
WITH u AS (SELECT event_id, user_id, ts FROM events WHERE event_type IN ('view', 'click')
           UNION ALL
           SELECT event_id, user_id, ts FROM events WHERE event_type NOT IN ('view', 'click')),
last AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, event_id AS last_event_id, ts AS last_ts, n_events
FROM last JOIN (SELECT user_id, COUNT(*) AS n_events FROM u GROUP BY user_id) n USING (user_id)
ORDER BY last_ts DESC, user_id""")
def q_ordered_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two event batches (browse and other) as a bag union (O4), the latest
    event per user, of two at one time the larger id (O3), ordered by time
    descending and user ascending (O1)."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    browse = e.where(F.col("event_type").isin("view", "click")).drop("event_type")
    other = e.where(~F.col("event_type").isin("view", "click")).drop("event_type")
    both = browse.unionByName(other)
    return (both.groupBy("user_id")
            .agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("last_event_id"), F.max("ts").alias("last_ts"),
                 F.count(F.lit(1)).alias("n_events"))
            .orderBy(F.col("last_ts").desc(), F.col("user_id").asc()))
