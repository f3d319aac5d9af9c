"""Day strings, period labels and the reporting month."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = "yyyyMMdd"
MONTH = "yyyyMM"


def partition_days(start: str, end: str) -> list[str]:
    """All days from start to end, both included; empty when start is later."""
    first = datetime.strptime(start, "%Y%m%d").date()
    last = datetime.strptime(end, "%Y%m%d").date()
    return [f"{first + timedelta(days=n):%Y%m%d}" for n in range((last - first).days + 1)]


def day_sequence(start: Column, end: Column) -> Column:
    """The same list as an array column of ``yyyyMMdd`` strings."""
    first, last = F.to_date(start, DAY), F.to_date(end, DAY)
    days = F.when(first <= last, F.sequence(first, last))
    return F.transform(F.coalesce(days, F.array().cast("array<date>")), day_string)


def day_string(day: Column) -> Column:
    return F.date_format(day, DAY)


def period_label(start: str | Column, end: str | Column) -> Column:
    """``start-end``, the label of the usage period a row comes from."""
    parts = [F.lit(p) if isinstance(p, str) else p for p in (start, end)]
    return F.concat_ws("-", *parts)


def update_label(run_date: date | Column) -> Column:
    """Run date as ``dd/MM/yyyy``; a parameter, so a rerun gives the same rows."""
    return F.date_format(run_date if isinstance(run_date, Column) else F.lit(run_date), "dd/MM/yyyy")


def month_start(run_date: Column) -> Column:
    """First day of the month before the run date."""
    return day_string(F.trunc(F.add_months(run_date, -1), "MM"))


def month_end(run_date: Column) -> Column:
    """Last day of the month before the run date."""
    return day_string(F.last_day(F.add_months(run_date, -1)))


def run_label(run_date: Column) -> Column:
    """Month of the run itself, ``yyyyMM``."""
    return F.date_format(run_date, MONTH)


def lookback(run_date: Column, pattern: str = MONTH, days: int = 30) -> Column:
    """A day some days before the run date, in the given format."""
    return F.date_format(F.date_sub(run_date, days), pattern)
