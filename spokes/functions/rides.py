"""Column expressions for ride features.

Durations are computed in integer microseconds and rounded once, so the
results do not depend on floating point: Postgres' numeric -> int cast rounds
half away from zero, which ``round_div`` reproduces exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import round_div


def duration_micros(start: str = "started_at", end: str = "ended_at") -> Column:
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end))


def duration_seconds(micros: Column) -> Column:
    """EXTRACT(epoch FROM end - start)::int  (H6)."""
    return round_div(micros, F.lit(1_000_000)).cast("int")


def duration_minutes(micros: Column) -> Column:
    """ROUND(epoch / 60.0, 2) as DECIMAL(12,2)  (H7)."""
    hundredths = round_div(micros, F.lit(600_000))
    return (hundredths.cast("decimal(14,0)") / F.lit(100)).cast("decimal(12,2)")


def iso_dow(ts: Column) -> Column:
    """1 = Monday .. 7 = Sunday  (H3)."""
    return (F.weekday(ts) + 1).cast("int")


def dow_name(ts: Column) -> Column:
    """TO_CHAR(ts, 'Day'): English day name blank-padded to 9  (H4)."""
    return F.rpad(F.date_format(ts, "EEEE"), 9, " ")


def month_start(ts: Column) -> Column:
    """DATE_TRUNC('month', ts)::date  (H5)."""
    return F.trunc(F.to_date(ts), "month")


def is_night_owl(hour: Column) -> Column:
    """Hour 0..4 inclusive  (H8)."""
    return hour.between(0, 4)


def is_round_trip(a: Column, b: Column) -> Column:
    """a = b, NULL when either side is NULL  (H9)."""
    return a == b


def is_between_stations(a: Column, b: Column) -> Column:
    """a IS DISTINCT FROM b  (H10)."""
    return ~a.eqNullSafe(b)
