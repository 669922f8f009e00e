"""Display labels as Column expressions.

Formatting follows the dashboard helpers: compact counts (1.2K, 25K,
3.4M, 1.0B), hours, minutes and percents.  Rounding to the shown digits is
half-even like Python's format spec.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Slug -> label dictionary (fixed values): the reference systems and the fixture systems.
SYSTEM_LABELS = {
    "capitalbikeshare": "DC",
    "citibike": "NYC",
    "alpha": "Alpha",
    "beta": "Beta",
}

DASH = "—"


def system_label(system: Column) -> Column:
    """Slug -> city label, the slug itself when unknown."""
    m = F.create_map(*[F.lit(x) for kv in SYSTEM_LABELS.items() for x in kv])
    return F.coalesce(m[system], system)


def _f(x: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", F.bround(x, digits))


def compact(n: Column) -> Column:
    """25,000,000 -> '25.0M', 12,345 -> '12K', 1,234 -> '1.2K', 999 -> '999'."""
    v = F.abs(n.cast("double"))
    sign = F.when(n < 0, F.lit("-")).otherwise(F.lit(""))
    body = (
        F.when(v >= 1e9, F.concat(_f(v / 1e9, 1), F.lit("B")))
        .when(v >= 1e6, F.concat(_f(v / 1e6, 1), F.lit("M")))
        .when(v >= 1e4, F.concat(_f(v / 1e3, 0), F.lit("K")))
        .when(v >= 1e3, F.concat(_f(v / 1e3, 1), F.lit("K")))
        .otherwise(F.floor(v).cast("bigint").cast("string"))
    )
    return F.concat(sign, body)


def hours(h: Column) -> Column:
    v = h.cast("double")
    return (
        F.when(v >= 1e6, F.concat(_f(v / 1e6, 1), F.lit("M hrs")))
        .when(v >= 1e4, F.concat(_f(v / 1e3, 0), F.lit("K hrs")))
        .when(v >= 1e3, F.concat(_f(v / 1e3, 1), F.lit("K hrs")))
        .otherwise(F.concat(F.format_number(F.bround(v, 0), 0), F.lit(" hrs")))
    )


def minutes(m: Column) -> Column:
    v = m.cast("double")
    out = (
        F.when(v >= 1000, F.concat(_f(v / 1000, 1), F.lit("k min")))
        .when(v >= 100, F.concat(_f(v, 0), F.lit(" min")))
        .otherwise(F.concat(_f(v, 1), F.lit(" min")))
    )
    return F.when(v.isNull(), F.lit(DASH)).otherwise(out)


def percent(p: Column, digits: int = 1) -> Column:
    v = p.cast("double")
    return F.when(v.isNull(), F.lit(DASH)).otherwise(F.concat(_f(v * 100, digits), F.lit("%")))
