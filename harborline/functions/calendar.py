"""Event time, industrial weeks and hour offsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(text: Column) -> Column:
    """Timestamp of a text value; null when it cannot be read."""
    return F.try_to_timestamp(text)


def moment(text: str) -> Column:
    """Fixed reference time of a run, used in place of the wall clock."""
    return F.lit(text).cast("timestamp_ntz")


def add_hours(ts: Column, hours: Column) -> Column:
    """Shift by a fractional number of hours, exact to the second."""
    return F.timestamp_add("SECOND", F.round(hours * F.lit(3600.0)).cast("int"), ts)


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def days_between(start: Column, end: Column) -> Column:
    return F.round(F.timestamp_diff("SECOND", start, end) / F.lit(86400.0), 1)


def industrial_week(day: Column) -> Column:
    """``IWnn`` with the ISO week number."""
    return F.concat(F.lit("IW"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def week_names(first: int = 14, count: int = 10) -> list[str]:
    return [f"IW{week:02d}" for week in range(first, first + count)]


def landing_path(kind: Column, ts: Column) -> Column:
    """``kind/yyyy/MM/dd/HHmm`` folder of an event."""
    return F.concat_ws("/", kind, F.date_format(ts, "yyyy/MM/dd/HHmm"))
