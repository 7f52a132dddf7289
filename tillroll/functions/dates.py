"""Date and time expressions on TIMESTAMP_NTZ (wall-clock) columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_days(start: Column | str, end: Column | str) -> Column:
    """Whole elapsed days from ``start`` to ``end``: floor of 24-hour periods.

    This is not a calendar-date difference: 23:00 -> 01:00 two dates later is
    1 day, not 2. Computed as the date difference, minus one when adding that
    many days to ``start`` overshoots ``end``. Wall-clock arithmetic on NTZ
    values, so the result does not depend on the session time zone.
    """
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    dd = F.datediff(F.to_date(e), F.to_date(s))
    return (dd - F.when(F.timestamp_add("DAY", dd, s) > e, 1).otherwise(0)).cast("int")


def month_start(ts: Column | str) -> Column:
    """First instant of the month, kept as TIMESTAMP_NTZ."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def plus_days(ts: Column | str, days: int) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_add("DAY", F.lit(days), c)
