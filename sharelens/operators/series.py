"""Long-form time-series operators.

A series frame is long: ``(series, date, value)``.  The reference keeps one
wide frame whose index is the union of all dates; a row-based rolling window
on that frame counts calendar positions, not observations.  Here every row
gets its position on the same union calendar (``cal_idx``) and all rolling
frames are RANGE frames over that position, partitioned by series -- so the
missing positions behave as the wide frame's NULLs without materialising a
dates x series grid.

Input contract: at most one row per (series, date) -- a daily series, as the
share fact and the price table are.  A window partitioned by series then
holds one row per day of that series, bounded by the calendar, never by the
raw volume behind it; aggregate first (``daily_share``) when starting from
raw rows.  A series longer than a task should hold (ticks, seconds) is cut into
slices of ``slice_positions`` calendar positions: a window then holds one slice
of one series and, before it, the few positions it looks back on; what may lie
further back, the last value there was, comes from an aggregate of one row for
each slice.  The rows are the same with and without slices.

Calendar modes:
* ``"observed"``: union of the dates present (the reference's pivot index),
  numbered by a distributed sequence index (``indexing.sequence_index``).
* ``"daily"``: every calendar day; the position is ``datediff(date, epoch)``,
  so no calendar is built at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .indexing import sequence_index

CAL = "cal_idx"


def calendar(df: DataFrame, date_col: str) -> DataFrame:
    """Distinct dates of ``df`` numbered 1..n in date order (distributed)."""
    dates = df.select(date_col).where(F.col(date_col).isNotNull()).distinct()
    return sequence_index(dates, date_col, CAL)


def with_calendar(df: DataFrame, date_col: str, mode: str = "observed") -> DataFrame:
    """Add ``cal_idx``: the row's position on the union calendar.

    The observed calendar reads ``df`` twice (rows and distinct dates), so the
    series frame -- one row per (series, day), small by contract -- is
    checkpointed first: the plan that produced it runs once, not per branch.
    """
    if mode == "daily":
        return df.withColumn(CAL, F.datediff(F.col(date_col), F.lit("1970-01-01").cast("date")))
    if mode != "observed":
        raise ValueError(f"unknown calendar mode {mode!r}")
    x = cut_lineage(df)
    return x.join(calendar(x, date_col), date_col)


def _frame(series_col: str | Sequence[str]) -> Window:
    keys = [series_col] if isinstance(series_col, str) else list(series_col)
    return Window.partitionBy(*keys).orderBy(CAL)


def _sliced(x: DataFrame, positions: int, lookback: int) -> DataFrame:
    """Rows of a numbered frame with their ``_slice``; those that the next slice looks back on stand there too, not ``_own``."""
    if positions < lookback:
        raise ValueError(f"slices of {positions} positions are shorter than the {lookback} looked back on")
    at = F.floor(F.col(CAL) / positions)
    seen_again = F.col(CAL) >= (at + 1) * positions - lookback
    here, ahead = F.struct(at.alias("s"), F.lit(True).alias("own")), F.struct((at + 1).alias("s"), F.lit(False).alias("own"))
    places = F.when(seen_again, F.array(here, ahead)).otherwise(F.array(here))
    return x.withColumn("_p", F.explode(places)).withColumns({"_slice": F.col("_p.s"), "_own": F.col("_p.own")}).drop("_p")


def _carried(x: DataFrame, keys: list[str], value_col: str, positions: int, lookback: int) -> DataFrame:
    """``(keys, _slice, _carried)``: the last value before all that a slice sees, itself and what it looks back on."""
    at = F.floor(F.col(CAL) / positions)
    there = F.col(value_col).isNotNull()
    early = there & (F.col(CAL) < (at + 1) * positions - lookback)
    last = x.groupBy(*keys, at.alias("_slice")).agg(F.max_by(value_col, F.when(there, F.col(CAL))).alias("_any"),
                                                    F.max_by(value_col, F.when(early, F.col(CAL))).alias("_early"))
    w = Window.partitionBy(*keys).orderBy("_slice")
    before = F.last("_any", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, -2))
    return last.select(*keys, "_slice", F.coalesce(F.last("_early").over(w.rangeBetween(-1, -1)), before).alias("_carried"))


def rolling_features(
    df: DataFrame,
    series_col: str,
    date_col: str,
    value_col: str,
    window: int = 7,
    mode: str = "observed",
    pad: bool = True,
    prefix: str = "",
    slice_positions: int | None = None,
) -> DataFrame:
    """Rolling mean (W4), rate of change over ``window`` positions (W5) and
    rolling z-score with its sign (W6), per series.

    Mean and z-score need ``window`` non-NULL values in the last ``window``
    calendar positions (pandas ``rolling(window)``); std is the sample std.
    ``pad=True`` carries the last value forward before the rate of change, as
    pandas 2.x ``pct_change`` does; ``pad=False`` needs both exact positions.
    Division by zero gives NULL.  ``slice_positions``: see the module.
    """
    x = with_calendar(df, date_col, mode)
    keys = [series_col] if isinstance(series_col, str) else list(series_col)
    if slice_positions:
        numbered = x = cut_lineage(x)
        x = _sliced(x, slice_positions, window)
        if pad:
            carried = _carried(numbered, keys, value_col, slice_positions, window).select(
                *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_at"), "_carried")
            same = (F.col("_slice") == F.col("_at"))
            for i, k in enumerate(keys):
                same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
            x = x.join(carried, same, "left")
        keys = [*keys, "_slice"]
    w = _frame(keys)
    last_n = w.rangeBetween(-(window - 1), 0)
    v = F.col(value_col)
    full = F.count(v).over(last_n) == F.lit(window)
    mean = F.when(full, F.avg(v).over(last_n))
    std = F.when(full, F.stddev_samp(v).over(last_n))
    if pad:
        now = F.last(v, ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0))
        then = F.last(v, ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, -window))
        if slice_positions:
            now, then = F.coalesce(now, "_carried"), F.coalesce(then, "_carried")
    else:
        now = v
        then = F.first(v).over(w.rangeBetween(-window, -window))
    z = F.try_divide(v - mean, std)
    own = ["_own"] if slice_positions else []
    out = x.select(
        *df.columns,
        *own,
        mean.alias(f"{prefix}ma{window}"),
        (F.try_divide(now, then) - F.lit(1.0)).alias(f"{prefix}roc{window}"),
        z.alias(f"{prefix}zscore"),
        F.signum(z).alias(f"{prefix}zscore_sign"),
    )
    return out.where("_own").drop("_own") if slice_positions else out


def _with_previous(df: DataFrame, series_col: str, date_col: str, value_col: str, mode: str, slice_positions: int | None) -> DataFrame:
    """``df`` with ``_prev``, the series' value one calendar position earlier."""
    x = with_calendar(df, date_col, mode)
    if not slice_positions:
        return x.withColumn("_prev", F.first(value_col).over(_frame(series_col).rangeBetween(-1, -1)))
    w = _frame([series_col, "_slice"]).rangeBetween(-1, -1)
    return _sliced(x, slice_positions, 1).withColumn("_prev", F.first(value_col).over(w)).where("_own")


def log_returns(df: DataFrame, series_col: str, date_col: str, price_col: str,
                mode: str = "observed", out: str = "log_return", slice_positions: int | None = None) -> DataFrame:
    """``ln(p / p_prev)`` where ``p_prev`` is the price one position earlier on
    the union calendar of all series (W7): a day missing for one series gives
    NULL on the next day, as in the wide frame."""
    x = _with_previous(df, series_col, date_col, price_col, mode, slice_positions)
    ratio = F.try_divide(F.col(price_col), F.col("_prev"))
    return x.select(*df.columns, F.when(ratio > 0, F.ln(ratio)).alias(out))


def latest_k(df: DataFrame, series_col: str, order_col: str, k: int = 5, per_series: bool = False) -> DataFrame:
    """Rows of the last ``k`` dates.

    Default: ``tail(k)`` of the wide frame -- the ``k`` latest dates of the
    union calendar, every series' rows on them (a series missing there simply
    has no row).  The date list is a distributed top-k of the distinct dates
    (at most ``k`` rows, broadcast).  ``per_series=True`` keeps each series'
    own last ``k`` rows instead (a rank filter planned as a WindowGroupLimit,
    so each task keeps ``k`` rows per series before the shuffle).
    """
    if per_series:
        w = Window.partitionBy(series_col).orderBy(F.col(order_col).desc())
        return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")
    last = df.select(order_col).where(F.col(order_col).isNotNull()).distinct() \
        .orderBy(F.col(order_col).desc()).limit(k)
    return df.join(F.broadcast(last), order_col, "left_semi")


def series_profile(df: DataFrame, series_col: str, date_col: str,
                   names: Mapping[str, str] | None = None) -> DataFrame:
    """Rows, first and last date per series (A5)."""
    n = {"rows": "n_rows", "first": "first_date", "last": "last_date"}
    n.update(names or {})
    return df.groupBy(series_col).agg(
        F.count(F.lit(1)).alias(n["rows"]),
        F.min(date_col).alias(n["first"]),
        F.max(date_col).alias(n["last"]),
    )


def pivot_wide(df: DataFrame, index_col: str, series_col: str, value_col: str,
               values: Sequence[str], rename: Mapping[str, str] | None = None) -> DataFrame:
    """Wide ``index x series`` table (A7/A8).  The series values are given, so
    Spark skips the extra distinct job; columns are renamed by name."""
    wide = df.groupBy(index_col).pivot(series_col, list(values)).agg(F.first(value_col))
    for old, new in (rename or {}).items():
        wide = wide.withColumnRenamed(old, new)
    return wide


def date_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ffill: bool = False,
              date_col: str | None = None, fill_cols: Sequence[str] = ()) -> DataFrame:
    """Inner join of two series frames on ``keys`` (J6).  ``ffill=True`` first
    carries ``fill_cols`` of ``left`` forward onto ``right``'s dates (the
    alignment the reference describes but does not do)."""
    if not ffill:
        return left.join(right, list(keys))
    if date_col is None:
        raise ValueError("ffill needs date_col")
    others = [k for k in keys if k != date_col]
    both = right.select(*keys).join(left, list(keys), "full")
    w = Window.partitionBy(*others).orderBy(date_col).rowsBetween(Window.unboundedPreceding, 0)
    filled = both.select(*keys, *[F.last(c, ignorenulls=True).over(w).alias(c) for c in fill_cols])
    return filled.join(right, list(keys))


def align_calendars(left: DataFrame, right: DataFrame, series_col: str, date_col: str) -> DataFrame:
    """Long-form twin of inner-joining two *wide* frames on their date index
    (J6 as the reference does it): the joined calendar is the dates of
    ``left`` (any series) that are also dates of ``right`` (any series); on
    those dates every (series, date) present on either side is a row, the
    other side's columns NULL where that series has no value -- the NaN cells
    of the wide join.  No grid: rows exist only where a value exists.
    """
    common = left.select(date_col).distinct().join(right.select(date_col).distinct(), date_col)
    lft = left.join(common, date_col, "left_semi")
    rgt = right.join(common, date_col, "left_semi")
    return lft.join(rgt, [series_col, date_col], "full")


def calendar_difference(df: DataFrame, series_col: str, date_col: str, value_col: str,
                        out: str | None = None, slice_positions: int | None = None) -> DataFrame:
    """``x - x_prev`` where ``x_prev`` is the series' value at the previous
    position of the frame's own union calendar (W8 on a wide frame): a
    missing or NULL previous cell gives NULL, as ``diff`` does on NaN."""
    x = _with_previous(df, series_col, date_col, value_col, "observed", slice_positions)
    return x.select(*df.columns, (F.col(value_col) - F.col("_prev")).alias(out or f"{value_col}_change"))


def paired(df: DataFrame, x: str, y: str) -> tuple[Column, Column]:
    """``x``/``y`` with each NULL where the other is NULL (pairwise deletion, J7)."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    return F.when(both, F.col(x)), F.when(both, F.col(y))
