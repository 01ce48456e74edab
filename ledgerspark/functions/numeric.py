"""Exact half-up rounding of ratios with integer arithmetic (no double in the path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up_ratio(num: Column, den: Column, scale: int = 2, factor: int = 1) -> Column:
    """round(factor * num / den, scale), half away from zero, as double.

    ``num * factor * 10**scale`` must be integral (counts, seconds, sums of cents). The
    quotient is an exact integer division on decimal(38,0) via ``pmod``, so no intermediate
    rounding can push a value across the half; one final cast to double.
    """
    p = 10 ** scale
    n = (num * F.lit(factor * p)).cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    a = F.abs(n) * 2 + d
    b = d * 2
    q = ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")
    rounded = F.when(n < 0, -q).otherwise(q)
    return (rounded / F.lit(p)).cast("double")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from start to end; independent of the session time zone."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("SECOND", s, e)
