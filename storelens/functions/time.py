"""Date and timestamp expressions that ignore the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def coerce_timestamp(name: str) -> Column:
    """Parse to a zone-less timestamp; anything unparseable becomes null."""
    return F.expr(f"try_cast(`{name}` AS timestamp_ntz)")


def _time_of_day(ts: Column) -> Column:
    return ts - ts.cast("date").cast("timestamp_ntz")


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days between two zone-less timestamps, rounded down (14 h early is -1)."""
    borrow = F.when(_time_of_day(later) < _time_of_day(earlier), 1).otherwise(0)
    return F.datediff(later, earlier) - borrow


def days_since(as_of: str, day: Column) -> Column:
    """Days from a date to a fixed cut-off; negative after the cut-off."""
    return F.datediff(F.lit(as_of).cast("date"), day)


def month_name_short(month: Column) -> Column:
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMM")
