"""Exact quantiles and ``describe`` without collecting a group into one task.

Built-in ``percentile`` keeps every distinct value of a group in one hash map
in one task; a group holding a third of the data would not fit.  Instead:

1. count rows per ``(group, value)`` (map-side combine);
2. range-partition those counts by ``(group, value)``: the sampler splits a
   hot group over many partitions by value; the assignment is checkpointed
   once so every later branch sees the same partition of each row;
3. running count within each ``(partition, group)`` slice -- bounded by the
   partition size, so no slice is hot;
4. prefix sums of the slice totals per group give each slice's offset (a
   table of at most partitions x groups rows);
5. each row knows the ranks it covers, so it takes the probabilities whose
   ranks ``floor/ceil((n-1) q)`` are among them -- no join -- and the values
   are interpolated linearly (pandas / DuckDB ``quantile_cont`` definition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import round_binary
from ..session import cut_lineage

_PID = "_pid"


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float], num_partitions: int | None = None) -> DataFrame:
    """``(group..., q, quantile)`` for every group and probability in ``probs``."""
    g = list(group_cols)
    v = value_col
    counts = (df.where(F.col(v).isNotNull())
              .groupBy(*g, v).agg(F.count(F.lit(1)).alias("_c")))
    order = [F.col(c).asc_nulls_first() for c in g] + [F.col(v).asc()]
    ranged = (counts.repartitionByRange(num_partitions, *order) if num_partitions
              else counts.repartitionByRange(*order))
    # The partition id feeds two branches (slice counts and slice totals).  Two
    # evaluations of a range exchange may sample different bounds, so the
    # assignment is checkpointed once and both branches read the same one.
    ranged = cut_lineage(ranged.withColumn(_PID, F.spark_partition_id()))
    # 3. running count inside each (partition, group) slice
    slice_w = Window.partitionBy(_PID, *g).orderBy(v).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_lc", F.sum("_c").over(slice_w))
    # 4. offsets of the slices, per group
    totals = ranged.groupBy(_PID, *g).agg(F.sum("_c").alias("_t"))
    off_w = Window.partitionBy(*g).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (totals.withColumn("_off", F.coalesce(F.sum("_t").over(off_w), F.lit(0)))
               .withColumn("_n", F.sum("_t").over(Window.partitionBy(*g))))
    ranks = (local.join(offsets.select(_PID, *g, "_off", "_n"), [_PID, *g])
             .select(*g, v, "_n",
                     (F.col("_off") + F.col("_lc") - F.col("_c")).alias("_lo"),   # first rank (0-based)
                     (F.col("_off") + F.col("_lc")).alias("_hi")))                # one past last rank
    # 5. each row takes the probabilities whose lower or upper rank it covers
    h = lambda q: (F.col("_n") - 1) * q
    covers = lambda r: (r >= F.col("_lo")) & (r < F.col("_hi"))
    mine = F.filter(F.array(*[F.lit(float(q)) for q in probs]), lambda q: covers(F.floor(h(q))) | covers(F.ceil(h(q))))
    hit = (ranks.withColumn("q", F.explode(mine)).withColumn("_h", h(F.col("q")))
           .withColumns({"_r0": F.floor("_h"), "_r1": F.ceil("_h")}))
    picked = hit.groupBy(*g, "q", "_h", "_r0").agg(
        F.max(F.when(covers(F.col("_r0")), F.col(v))).alias("_v0"),
        F.max(F.when(covers(F.col("_r1")), F.col(v))).alias("_v1"))
    frac = F.col("_h") - F.col("_r0")
    return picked.select(*g, "q", (F.col("_v0") + frac * (F.col("_v1") - F.col("_v0"))).alias("quantile"))


def describe(df: DataFrame, group_col: str, value_col: str, scale: float = 1.0,
             probs: Sequence[float] = (0.25, 0.5, 0.75), digits: int | None = None) -> DataFrame:
    """Per group: count, mean, std (n-1), min, quantiles, max of ``value * scale``
    (pandas ``describe``; the quantile columns are named ``p25``, ``p50``, ``p0_1`` for 0.001...),
    rounded to ``digits`` when given (the reference shows x100, 2 digits)."""
    x = df.select(group_col, (F.col(value_col) * F.lit(scale)).alias("_x"))
    stats = x.groupBy(group_col).agg(
        F.count("_x").alias("count"),
        F.avg("_x").alias("mean"),
        F.stddev_samp("_x").alias("std"),
        F.min("_x").alias("min"),
        F.max("_x").alias("max"),
    )
    q = exact_quantiles(x, [group_col], "_x", probs)
    names = {float(p): "p" + f"{p * 100:.10g}".replace(".", "_") for p in probs}
    wide = q.groupBy(group_col).pivot("q", list(names)).agg(F.first("quantile"))
    for p, name in names.items():
        wide = wide.withColumnRenamed(str(p), name)
    out = stats.join(wide, group_col, "left")
    if digits is None:
        return out
    return out.select(*[round_binary(c, digits).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])
