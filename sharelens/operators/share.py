"""Share-of-total aggregation.

Plan shape: partial aggregate per map task -> one shuffle on (date, group) ->
final aggregate -> a second, tiny shuffle of the aggregated rows on date for
the per-day total.  A hot group (a third of all rows) costs nothing extra:
map-side combine reduces it to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def share_of_total(total: str | Column, partition_by: Sequence[str]) -> Column:
    """``total / sum(total) over (partition_by)``; NULL for a zero-total partition."""
    t = F.col(total) if isinstance(total, str) else total
    return F.try_divide(t.cast("double"), F.sum(t).over(Window.partitionBy(*partition_by)).cast("double"))


def daily_share(
    df: DataFrame,
    date_col: str,
    group_col: str,
    value_col: str,
    distinct_col: str | None = None,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Per (date, group): total of ``value_col``, distinct ``distinct_col``
    (NULLs ignored), row count, and the group's share of the day (A1 + W3).

    ``names`` renames the outputs: keys ``total``, ``distinct``, ``rows``,
    ``share`` (defaults: total_streams, track_count, row_count, market_share_pct).
    """
    n = {"total": "total_streams", "distinct": "track_count", "rows": "row_count",
         "share": "market_share_pct"}
    n.update(names or {})
    aggs = [F.sum(value_col).alias(n["total"])]
    if distinct_col is not None:
        aggs.append(F.count_distinct(distinct_col).alias(n["distinct"]))
    aggs.append(F.count(F.lit(1)).alias(n["rows"]))
    agg = df.groupBy(date_col, group_col).agg(*aggs)
    return agg.withColumn(n["share"], share_of_total(n["total"], [date_col]))


def total_by_group(df: DataFrame, group_col: str, value_col: str, total_name: str = "total") -> DataFrame:
    """Total per group, largest first (A3)."""
    return (df.groupBy(group_col).agg(F.sum(value_col).alias(total_name))
            .orderBy(F.col(total_name).desc(), F.col(group_col)))


def share_table(
    df: DataFrame,
    group_col: str,
    value_col: str,
    subtotal_groups: Sequence[str],
    subtotal_name: str,
    total_name: str = "total",
    share_name: str = "share_pct",
    kind_name: str = "row_kind",
) -> DataFrame:
    """Total and share of the grand total per group, plus one subtotal row over
    ``subtotal_groups`` (A4: the "Big 3 total" line).

    ``kind_name`` tells a ``group`` row from the ``subtotal`` row, so a group
    that is named like the subtotal, or NULL, is a group like any other.  The
    per-group totals are computed once; their two sums (one row) are literals.
    """
    per_group = cut_lineage(df.groupBy(group_col).agg(F.sum(value_col).alias(total_name)))
    kind = per_group.schema[total_name].dataType
    picked = F.when(F.col(group_col).isin(list(subtotal_groups)), F.col(total_name))
    grand, sub = per_group.agg(F.sum(total_name), F.sum(picked)).first()
    one = df.sparkSession.range(1).select(F.lit(subtotal_name).alias(group_col), F.lit(sub).cast(kind).alias(total_name),
                                          F.lit("subtotal").alias(kind_name))
    rows = per_group.select(group_col, total_name, F.lit("group").alias(kind_name)).unionByName(one)
    return rows.withColumn(share_name, F.try_divide(F.col(total_name).cast("double"), F.lit(grand).cast("double")))
