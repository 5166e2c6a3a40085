"""DataFrame helpers of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .textarrays import groups_of_bytes


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_mod(c: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m; a null id counts as remainder 0."""
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(m)), F.lit(0))


def packed(df: DataFrame) -> DataFrame:
    """The whole row as one struct column ``row``: no name in it can clash with ours."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def text_of(df: DataFrame, name: str) -> Column:
    return df["row"].getField(name)


def release_memory() -> None:
    """Give what a finished task has freed back to the system: Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc
    if trim:
        trim(0)


def releasing(fn):
    """A function of a task's batches that gives its memory back at the end."""

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            release_memory()

    return run


def text_udf(fn: Callable[[list], dict], schema: str, make: Callable[[], object] | None = None):
    """A vectorised function of a text column that returns a struct of ``schema``.

    ``fn(texts[, state])`` gets slices of about 1 MB (or one longer text) and
    returns one list or array for each field; ``make`` builds the state once
    for each Python worker task.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(schema)
    arrow = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        state = [make()] if make else []
        try:
            for batch in batches:
                batch = batch.cast(pa.string()) if not pa.types.is_string(batch.type) else batch
                sizes = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False)
                if not len(sizes):
                    yield pa.array([], arrow)
                for i, j in groups_of_bytes(sizes.tolist()):  # a result for each slice: no more is held at once
                    got = fn(batch.slice(i, j - i).to_pylist(), *state)
                    yield pa.StructArray.from_arrays([pa.array(got[f.name], f.type) for f in arrow], fields=list(arrow))
        finally:
            state.clear()
            release_memory()

    return run
