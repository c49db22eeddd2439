"""Date and time columns.

A timestamp is an instant. The calendar date of an instant depends on the zone, so
functions that cut dates take one; without it the session's zone applies.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(text: Column) -> Column:
    """Parse ISO-8601 text; null where it is no timestamp."""
    return F.try_to_timestamp(text)


def wall_clock(ts: Column, zone: str) -> Column:
    """Zone-less local time of an instant in ``zone``, whatever the session's zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def local_date(ts: Column, zone: str | None = None) -> Column:
    """Calendar date of an instant."""
    return F.to_date(ts if zone is None else wall_clock(ts, zone))


def as_date(value) -> Column:
    """A date column from None (today), a date, ISO text or a column."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value).cast("date")


def as_instant(value) -> Column:
    """A timestamp column from None (now), a datetime, ISO text or a column."""
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def minutes_before(ts: Column, minutes: int) -> Column:
    return ts - F.make_dt_interval(mins=F.lit(int(minutes)))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("int")
