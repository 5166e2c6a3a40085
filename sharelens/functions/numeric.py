"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_binary(c: str | Column, digits: int) -> Column:
    """Round a double the way the reference's engine does: scale the binary
    value, round half away from zero, scale back (``round(x * 10^d) / 10^d``).

    Spark's ``round`` rounds the shortest decimal form of the double instead,
    so the two disagree on values such as 2058.8259375 whose binary value
    lies just below the half.  Scaling first makes the tie visible in the
    product, where both rules agree.
    """
    x = F.col(c) if isinstance(c, str) else c
    scale = F.lit(float(10 ** digits))
    return F.round(x * scale, 0) / scale
