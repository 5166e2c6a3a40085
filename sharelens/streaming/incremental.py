"""New daily files -> share fact, as a Structured Streaming job.

The reference is batch (a daily cron that appends one day).  The streaming
form covers "a new daily file arrives" with a file source and
``Trigger.AvailableNow``: every micro-batch

1. takes the distinct dates of its new rows,
2. re-reads *all* chart rows of those dates from the static table (a
   left-semi join on the date, so dynamic partition pruning reads only those
   folders) -- a late file for an old date is merged, not lost,
3. rebuilds the fact for those dates and overwrites exactly their
   partitions.

Replaying a micro-batch after a failure rewrites the same partitions with
the same rows, so the sink is idempotent; progress lives in the streaming
checkpoint under the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..session import scratch_path
from ..sources.tables import write_partitions


def stream_daily_fact(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    build: Callable[[DataFrame], DataFrame],
    out_path: str,
    date_col: str = "chart_date",
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream; ``build(rows)`` turns chart rows into fact rows."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(source_dir)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        touched = batch.select(date_col).distinct()
        rows = (spark.read.schema(schema).parquet(source_dir)
                .join(touched, date_col, "left_semi"))
        write_partitions(build(rows), out_path, date_col)

    return (stream.writeStream.foreachBatch(upsert)
            .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt"))
            .trigger(availableNow=True)
            .start())


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query to drain its input, however long it
    takes; with ``timeout_s``, stop it then and raise."""
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError("stream did not finish")
    if query.exception() is not None:
        raise query.exception()

