"""Daily quote shaping (S13) and the price summary (A2)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..functions.numeric import round_binary
from ..operators.staging import map_keys
from .tables import snake_case_columns

# --- fixed values: the eight columns kept, in order --------------------------
PRICE_COLUMNS = ("date", "ticker", "company_name", "open", "high", "low", "close", "volume")
# ---------------------------------------------------------------------------


def shape_quotes(raw: DataFrame, ticker: str | Column, companies: Mapping[str, str],
                 zones: Mapping[str, str] | None = None) -> DataFrame:
    """Vendor quotes -> ``date, ticker, company_name, open, high, low, close,
    volume``: ticker and company (by name from ``companies``) added, headers
    snake-cased, time zone dropped to a date, empty rows dropped.

    Where ``date`` is an instant, its date is the one on the wall of the
    ticker's exchange: ``zones`` maps a ticker to its time zone, and a ticker
    without one keeps the session's.  A date or a timestamp without a zone is
    local already."""
    t = F.col(ticker) if isinstance(ticker, str) else ticker
    x = snake_case_columns(raw.withColumn("ticker", t))
    x = x.withColumn("company_name", map_keys("ticker", companies))
    day = F.col("date")
    if x.schema["date"].dataType == TimestampType() and zones:
        wall = day.cast("timestamp_ntz")
        zone = map_keys("ticker", zones)
        day = F.when(zone.isNull(), wall).otherwise(F.convert_timezone(F.current_timezone(), zone, wall))
    x = x.withColumn("date", F.to_date(day))
    x = x.select(*PRICE_COLUMNS)
    return x.where(F.col("date").isNotNull() & F.col("ticker").isNotNull())


def price_summary(prices: DataFrame) -> DataFrame:
    """Per ticker and company: first/last date, trading days, rounded
    average/min/max close, ordered by ticker (A2)."""
    return (prices.groupBy("ticker", "company_name").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("trading_days"),
        round_binary(F.avg("close"), 2).alias("avg_close"),
        round_binary(F.min("close"), 2).alias("min_close"),
        round_binary(F.max("close"), 2).alias("max_close"))
        .orderBy("ticker"))
