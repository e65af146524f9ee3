"""Dates and instants. Unreadable text gives null, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_day(value: Column | str) -> Column:
    """The calendar day as written: an offset in ISO text is not applied."""
    column = F.col(value) if isinstance(value, str) else value
    return column.try_cast("date")


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def event_time(ts_ms: Column | str) -> Column:
    """Epoch milliseconds as a timestamp, the type watermarks need."""
    return F.timestamp_millis(F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms)


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def iso_utc(instant: Column) -> Column:
    """An instant as ISO text in UTC, whatever the session time zone."""
    utc = F.to_utc_timestamp(instant, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
