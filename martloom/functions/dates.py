"""Run dates, trailing windows and calendar columns."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Folder patterns of the dated layouts and the default business zone.
DAY_FOLDER = "ddMMyyyy"
MONTH_FOLDER = "MM-yyyy"
BUSINESS_ZONE = "Asia/Almaty"


def as_date(value: date | str) -> date:
    """A run date given as a ``date``, a ``datetime`` or ISO text."""
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)


def resolve_as_of(word: str | date, today: date | None = None, zone: str = BUSINESS_ZONE) -> date:
    """``sysdate`` is today, ``sysmonth`` the first day of last month, anything else a date.

    The one place that may read the clock, and only when ``today`` is not given;
    everything below takes the date it returns.
    """
    if word not in ("sysdate", "sysmonth"):
        return as_date(word)
    today = today or datetime.now(ZoneInfo(zone)).date()
    if word == "sysdate":
        return today
    return (today.replace(day=1) - timedelta(days=1)).replace(day=1)


def day_literal(value: date | str) -> Column:
    """A date literal; it compares with date, timestamp and timestamp_ntz columns."""
    return F.lit(as_date(value))


def moment(value: date | datetime | str) -> Column:
    """A zone-free timestamp literal, for bounds inside a day."""
    if isinstance(value, (date, datetime)):
        value = value.isoformat(sep=" ") if isinstance(value, datetime) else value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def between_times(col: Column, lo, hi) -> Column:
    """Half-open range ``[lo, hi)`` on the bare column, so the scan can use it."""
    return (col >= moment(lo)) & (col < moment(hi))


def trailing(col: Column, as_of: date | str, days: int, inclusive: bool = False) -> Column:
    """The last ``days`` calendar days before ``as_of``, or up to and including it.

    Both bounds are on the bare column (no cast around it), which keeps parquet
    statistics and partition pruning usable.
    """
    end = as_date(as_of) + timedelta(days=1 if inclusive else 0)
    return (col >= day_literal(end - timedelta(days=days))) & (col < day_literal(end))


def days_ago(col: Column, as_of: date | str) -> Column:
    return F.datediff(day_literal(as_of), col)


def abs_day_diff(a: Column, b: Column) -> Column:
    return F.abs(F.datediff(a, b))


def truncate_date(col: Column, unit: str) -> Column:
    """First day of the month for ``mm``/``month``/``mon`` in any case; else unchanged."""
    return F.trunc(col, "MM") if unit.lower() in ("mm", "month", "mon") else col


def first_of_month(col: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(F.trunc(col, "MM"), pattern)


def start_of_day(col: Column) -> Column:
    return F.to_date(col).cast("timestamp_ntz")


def end_of_day(col: Column) -> Column:
    """23:59:59 of the column's day."""
    return start_of_day(col) + F.expr("interval '86399' second")


def previous_month_start(col: Column) -> Column:
    return F.add_months(F.trunc(col, "MM"), -1)
