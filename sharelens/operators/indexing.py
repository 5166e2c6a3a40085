"""Distributed sequence numbering (a DataFrame form of ``zipWithIndex``).

``sequence_index`` numbers the rows of ``df`` 1..n in ``order_col`` order
without sending them to one task: the rows are range-partitioned, numbered
inside each range, and shifted by the prefix sum of the ranges' sizes.  The
only global step is that prefix sum, over one row per partition -- bounded
by the shuffle-partition setting, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_PID = "_seq_pid"


def sequence_index(df: DataFrame, order_col: str, out: str = "idx") -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order_col`` order
    (ties get distinct, arbitrary positions; pass distinct values)."""
    # the partition id is read by two branches; a range exchange evaluated twice
    # may sample different bounds, so the assignment is checkpointed once
    ranged = cut_lineage(df.repartitionByRange(F.col(order_col).asc_nulls_first())
                         .withColumn(_PID, F.spark_partition_id()))
    local = ranged.withColumn("_seq_ln", F.row_number().over(Window.partitionBy(_PID).orderBy(order_col)))
    sizes = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_seq_n"))
    # one row per partition: the only un-partitioned window, bounded by the partition count
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_PID, F.coalesce(F.sum("_seq_n").over(before), F.lit(0)).alias("_seq_off"))
    # offsets hold one row per partition: a size bound set by configuration
    return (local.join(F.broadcast(offsets), _PID)
            .withColumn(out, F.col("_seq_off") + F.col("_seq_ln"))
            .drop(_PID, "_seq_ln", "_seq_off"))
