"""Business dates written as ``yyyyMMdd`` text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

FULL_HISTORY = "-1"


def compact_day(col: Column) -> Column:
    return F.date_format(col, "yyyyMMdd")


def compact_day_via_unixtime(col: Column) -> Column:
    """Same text by way of epoch seconds."""
    return F.from_unixtime(F.unix_timestamp(F.to_date(col)), "yyyyMMdd")


def resolve_business_date(
    configured: str | None = None, scheduled: str | None = None,
    today: dt.date | None = None, pattern: str = "%Y%m%d",
) -> str:
    """Job date: the configured one, else the scheduler's ``yyyyMMdd…`` stamp, else yesterday."""
    if configured is not None:
        return str(configured)
    if scheduled:
        return dt.datetime.strptime(scheduled[:8], "%Y%m%d").strftime(pattern)
    return ((today or dt.date.today()) - dt.timedelta(days=1)).strftime(pattern)


def period_bounds(period: str) -> tuple[dt.datetime, dt.datetime]:
    """Half-open time range of a ``yyyy``, ``yyyyMM`` or ``yyyyMMdd`` period."""
    if len(period) == 4:
        return dt.datetime(int(period), 1, 1), dt.datetime(int(period) + 1, 1, 1)
    if len(period) == 6:
        start = dt.datetime(int(period[:4]), int(period[4:]), 1)
        return start, (start + dt.timedelta(days=32)).replace(day=1)
    start = dt.datetime.strptime(period, "%Y%m%d")
    return start, start + dt.timedelta(days=1)


def period_sql(column: str, period: str) -> str:
    """:func:`in_period` as SQL text."""
    start, end = period_bounds(period)
    return f"({column} >= TIMESTAMP_NTZ '{start}' AND {column} < TIMESTAMP_NTZ '{end}')"


def in_period(col: Column, period: str) -> Column:
    """Timestamp in a period, as two plain comparisons so that scans can skip row groups."""
    start, end = (F.lit(str(b)).cast("timestamp_ntz") for b in period_bounds(period))
    return (col >= start) & (col < end)
