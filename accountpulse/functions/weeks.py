"""Week and month keys. A week is named by the Sunday that closes it."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEEK = "week_end_sunday"
MONTH = "month_start"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_end_sunday(ts: Column | str) -> Column:
    """Closing Sunday of the Monday-to-Sunday week that holds ``ts``."""
    day = F.to_date(_col(ts))
    return F.date_add(day, 6 - F.weekday(day))


def month_start(week: Column | str) -> Column:
    """First day of the month that holds the closing Sunday."""
    return F.trunc(_col(week), "MM")


def year_month(ts: Column | str) -> Column:
    """``yyyy-MM`` text of a timestamp."""
    return F.date_format(_col(ts), "yyyy-MM")


def since(df: DataFrame, column: str, start: date | str) -> Column:
    """``column >= start`` with the literal typed like the column.

    A cast on the column side would keep the comparison out of the Parquet scan,
    so the literal is converted instead.
    """
    return F.col(column) >= F.lit(str(start)).cast(df.schema[column].dataType)


def sunday_on_or_after(day: date) -> date:
    return day + timedelta(days=6 - day.weekday())


def last_closed_sunday(as_of: date, include_today: bool = True) -> date:
    """Last completed Sunday. ``include_today`` decides whether a Sunday closes itself."""
    back = (as_of.weekday() + 1) % 7 if include_today else as_of.weekday() + 1
    return as_of - timedelta(days=back)


def calendar_bounds(start: date, as_of: date) -> tuple[date, date]:
    """First and last Sunday of the licence calendar.

    The calendar begins on the first Sunday on or after ``start`` and ends on the first
    one that lies at least two weeks after ``as_of`` (or on its first week, if later).
    """
    first = sunday_on_or_after(start)
    return first, max(first, sunday_on_or_after(as_of + timedelta(days=14)))
