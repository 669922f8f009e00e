"""Dashboard filter object -> Column predicates."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _month(d: dt.date) -> dt.date:
    return dt.date(d.year, d.month, 1)


def _next_month(d: dt.date) -> dt.date:
    return dt.date(d.year + (d.month == 12), d.month % 12 + 1, 1)


@dataclass(frozen=True)
class RideFilter:
    """(systems, month_start, month_end); months are first-of-month dates, range closed.

    A reversed range is swapped (B18), like the page widget does.
    """

    systems: tuple[str, ...]
    month_start: dt.date
    month_end: dt.date

    def __post_init__(self):
        a, b = _month(self.month_start), _month(self.month_end)
        if a > b:
            a, b = b, a
        object.__setattr__(self, "month_start", a)
        object.__setattr__(self, "month_end", b)
        object.__setattr__(self, "systems", tuple(self.systems))

    # B5
    def system_pred(self, col: str = "system") -> Column:
        return F.col(col).isin(list(self.systems))

    # Half-open window on a date column
    def date_pred(self, col: str = "started_date") -> Column:
        c = F.col(col)
        return (c >= F.lit(self.month_start)) & (c < F.lit(_next_month(self.month_end)))

    # Same window on a timestamp_ntz column
    def ts_pred(self, col: str = "started_at") -> Column:
        c = F.col(col)
        lo = F.lit(dt.datetime.combine(self.month_start, dt.time())).cast("timestamp_ntz")
        hi = F.lit(dt.datetime.combine(_next_month(self.month_end), dt.time())).cast("timestamp_ntz")
        return (c >= lo) & (c < hi)

    # Closed window on the month key (partition pruning on started_month)
    def month_pred(self, col: str = "started_month") -> Column:
        return F.col(col).between(F.lit(self.month_start), F.lit(self.month_end))

    def daily(self, col: str = "started_date") -> Column:
        return self.system_pred() & self.date_pred(col)

    def monthly(self, col: str = "started_month") -> Column:
        return self.system_pred() & self.month_pred(col)
