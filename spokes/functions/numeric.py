"""Order-independent numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_div(n: Column, d: Column) -> Column:
    """Integer n / d rounded half away from zero (d > 0), in integer arithmetic alone.

    ``q + (2r >= d)`` of the integer quotient and remainder: nothing is doubled
    but the remainder, which is smaller than ``d``.
    """
    n, d = n.cast("bigint"), d.cast("bigint")
    q = F.call_function("div", F.abs(n), d)
    up = F.when(F.abs(n) % d >= d - F.abs(n) % d, F.lit(1)).otherwise(F.lit(0))
    return F.when(n < 0, -(q + up)).otherwise(q + up)


def exact_avg(col: Column, scale: int = 6) -> Column:
    """Average of a coordinate-like column at ``scale`` decimals.

    Values are fixed to integers (10^-scale units) before the sum, so the
    result does not depend on the order rows are summed in (partition layout,
    executor count).  NULLs are ignored, NULL when no value.
    """
    unit = 10**scale
    fixed = F.round(col.cast("double") * F.lit(float(unit))).cast("bigint")
    total = F.sum(fixed)
    n = F.count(fixed)
    return F.when(n > 0, round_div(total, n) / F.lit(float(unit)))
