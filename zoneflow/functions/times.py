"""Time literals and range predicates that do not depend on the session or process time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from zoneflow import schemas as S


def ntz(value: dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal with the given wall-clock value.

    Built from text: a Python ``datetime`` literal would be read in the process time zone and
    then shifted by the session time zone.
    """
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def as_wall_clock(ts: str | Column) -> Column:
    """A time column as local wall-clock ``timestamp_ntz``: an instant (``timestamp``) is converted
    to the documents' zone, whatever the session zone; a zone-less time already is local (L9).

    The type test is a constant that the optimizer folds, so a zone-less column stays as it is and
    its range predicates still reach the scan."""
    c = F.col(ts) if isinstance(ts, str) else ts
    instant = F.convert_timezone(None, F.lit(S.LOCAL_TIME_ZONE), c.cast("timestamp_ntz"))
    return F.when(F.typeof(c) == "timestamp", instant).otherwise(c.cast("timestamp_ntz"))


def tick_length(tick: str) -> dt.timedelta:
    """A tick such as ``1 hour`` or ``30 seconds`` as a timedelta."""
    count, unit = tick.split()
    return int(count) * {"second": dt.timedelta(seconds=1), "minute": dt.timedelta(minutes=1),
                         "hour": dt.timedelta(hours=1), "day": dt.timedelta(days=1)}[unit.rstrip("s")]


def tick_at_or_after(value: dt.datetime, tick: str) -> dt.datetime:
    """The first epoch-aligned tick end at or after a wall-clock time."""
    epoch, step = dt.datetime(1970, 1, 1), tick_length(tick)
    return epoch - (epoch - value) // step * step


def check_range_minutes(range_minutes: int) -> int:
    """PRJ-06 argument check: 1..1440 minutes."""
    if not isinstance(range_minutes, int) or isinstance(range_minutes, bool):
        raise TypeError("range_minutes must be an int")
    if not S.RANGE_MINUTES_MIN <= range_minutes <= S.RANGE_MINUTES_MAX:
        raise ValueError(
            f"range_minutes must be in {S.RANGE_MINUTES_MIN}..{S.RANGE_MINUTES_MAX}, got {range_minutes}")
    return range_minutes


def between_inclusive(col: str | Column, start: dt.datetime, end: dt.datetime) -> Column:
    """``start <= col <= end`` in local wall-clock time (a plain range predicate for a zone-less
    column, pushed into Parquet scans)."""
    c = as_wall_clock(col)
    return (c >= ntz(start)) & (c <= ntz(end))
