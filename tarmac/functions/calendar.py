"""Date parts and half-open time windows.

Windows compare the bare column with literals, so Parquet and JDBC scans can skip data.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import col


def as_date(value: str | date) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def between_days(ts: Column | str, first: str | date, last: str | date, whole_last_day: bool = True) -> Column:
    """Rows from ``first`` to ``last``.

    With ``whole_last_day`` false only midnight of the last day is inside, as when a timestamp is
    compared with a bare date string.
    """
    ts, first, last = col(ts), as_date(first), as_date(last)
    low = ts >= F.lit(first).cast("timestamp")
    if whole_last_day:
        return low & (ts < F.lit(last + timedelta(days=1)).cast("timestamp"))
    return low & (ts <= F.lit(last).cast("timestamp"))


def on_day(ts: Column | str, day: str | date) -> Column:
    return between_days(ts, day, day)


def lookback(ts: Column | str, as_of: str | date, days: int, whole_last_day: bool = True) -> Column:
    """The ``days`` before ``as_of`` up to ``as_of``."""
    as_of = as_date(as_of)
    return between_days(ts, as_of - timedelta(days=days), as_of, whole_last_day)


def previous_month(as_of: str | date) -> tuple[date, date]:
    """First and last day of the month before ``as_of``."""
    last = as_date(as_of).replace(day=1) - timedelta(days=1)
    return last.replace(day=1), last


def day_of_week(ts: Column | str) -> Column:
    """Sunday is 0."""
    return F.dayofweek(col(ts)) - 1


def add_calendar_parts(df: DataFrame, ts: str, with_hour: bool = True) -> DataFrame:
    """Staging columns: hour, weekday, day, month, year."""
    parts = {
        "day_of_week": day_of_week(ts),
        "day_of_month": F.dayofmonth(ts),
        "month": F.month(ts),
        "year": F.year(ts),
    }
    if with_hour:
        parts = {"hour_of_day": F.hour(ts), **parts}
    return df.withColumns(parts)


def whole_days(start: Column, end: Column) -> Column:
    """Completed days between two timestamps (floor, also for negative spans)."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    day = F.lit(86_400_000_000)
    return ((micros - F.pmod(micros, day)) / day).cast("bigint")
