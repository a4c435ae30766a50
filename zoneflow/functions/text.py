"""Text columns: ISO timestamps, document keys, sensor ids, JSON encoding (SC-08, SC-09, SC-12, SC-13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zoneflow import schemas as S
from zoneflow.functions.times import as_wall_clock

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def iso_text(ts: str | Column, offset: str | None = None) -> Column:
    """SC-08: a timestamp as ``yyyy-MM-ddTHH:mm:ss`` text, optionally with a fixed offset suffix.

    For ``timestamp_ntz`` input the text is the wall-clock value, whatever the session zone.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    text = F.date_format(c, ISO_SECONDS)
    return F.concat(text, F.lit(offset)) if offset else text


def document_time_text(ts: str | Column, offset: str = S.LOCAL_UTC_OFFSET) -> Column:
    """SC-08: a time (an instant or a local wall-clock time) as document text: ``yyyy-MM-ddTHH:mm:ss``, then
    ``.ffffff`` only when the microseconds are not zero, then the local offset
    (``2024-01-01T07:36:12.733472+05:30``, ``2024-01-01T08:00:00+05:30``)."""
    c = as_wall_clock(ts)
    micros = F.date_format(c, "SSSSSS")
    fraction = F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit(""))
    return F.concat(F.date_format(c, ISO_SECONDS), fraction, F.lit(offset))


def store_time_text(ts: str | Column, zone: str = S.LOCAL_TIME_ZONE) -> Column:
    """AG-11: a time (an instant or a local wall-clock time) as the store prints a date aggregate:
    the same instant in UTC with milliseconds (``2024-01-31T00:00:00`` local -> ``2024-01-30T18:30:00.000Z``)."""
    return F.date_format(F.convert_timezone(F.lit(zone), F.lit("UTC"), as_wall_clock(ts)), S.STORE_TIME_FORMAT)


def document_key(zone: str | Column = "zone",
                 synchronized_time: str | Column = "synchronized_time") -> Column:
    """SC-09: ``<zone>-<synchronized time as document text>``."""
    z = F.col(zone) if isinstance(zone, str) else zone
    t = F.col(synchronized_time) if isinstance(synchronized_time, str) else synchronized_time
    return F.concat_ws("-", z, document_time_text(t))


def sensor_id(topic: str, zone_name: str | Column) -> Column:
    """SC-12: prefix + upper(zone without spaces) + suffix."""
    z = F.col(zone_name) if isinstance(zone_name, str) else zone_name
    return F.concat(F.lit(S.SENSOR_PREFIX[topic]), F.upper(F.replace(z, F.lit(" "), F.lit(""))),
                    F.lit(S.SENSOR_SUFFIX))


def json_encode(*cols: str | Column) -> Column:
    """SC-13: one JSON object per row from the given columns; null fields stay, as ``null``."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
