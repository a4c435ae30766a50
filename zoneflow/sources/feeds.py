"""Raw public-feed payloads (SRC-09, SRC-10): landed nested JSON flattened into readings.

The answers of two public services are a landed table (one JSON payload per poll) and the
reshaping is a column job: ``from_json`` with the nested schema and the first element of the hourly
arrays by ``get`` (null-safe on empty arrays). An air-quality answer counts only in an envelope of
status ``ok``, else the whole fixed baseline stands in; a weather answer with any part missing is
replaced as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow import schemas as S
from zoneflow.functions.text import iso_text, sensor_id
from zoneflow.operators.zones import with_zone_attributes

FEED_TZ_SUFFIX = "+05:30"


def flatten_aqi_feed(polls: DataFrame) -> DataFrame:
    """SRC-09: the baseline reading of each poll.

    The answer's ``data`` counts if its ``status`` is ``ok``: missing pollutants stay null there
    and a missing index takes its default. Any other answer (an error status, no envelope, text
    that is no JSON, null) is a failed poll and gives the fixed baseline, stamped with the poll's time.
    """
    d = F.from_json("payload", S.AQI_FEED_SCHEMA)
    failed, iaqi = S.AQI_FEED_FAILED, {"pm25": "pm25", "pm10": "pm10", "no2": "no2", "co": "co",
                                       "t": "temperature", "h": "humidity", "w": "wind"}
    answered = (F.col("d.status") == S.AQI_FEED_OK) & F.col("d.data").isNotNull()
    fetched = iso_text("fetched_at", FEED_TZ_SUFFIX)
    return (polls.select("poll_id", "fetched_at", d.alias("d"))
            .withColumn("ok", F.coalesce(answered, F.lit(False)))
            .select("poll_id", "fetched_at",
                    F.when(F.col("ok"), F.coalesce("d.data.aqi", F.lit(S.AQI_FEED_DEFAULTS["aqi"])))
                    .otherwise(failed["aqi"]).alias("base_aqi"),
                    *[F.when(F.col("ok"), F.col(f"d.data.iaqi.{src}.v")).otherwise(float(failed[src]))
                      .alias(f"base_{out}") for src, out in iaqi.items()],
                    F.when(F.col("ok"), F.coalesce("d.data.time.iso", fetched)).otherwise(fetched)
                    .alias("timestamp")))


def flatten_weather_feed(polls: DataFrame, zones: DataFrame) -> DataFrame:
    """SRC-10 + JN-04 + SC-12: a weather reading per poll: current values and the first hourly
    elements with the zone's coordinates. If the answer lacks a part that is looked up (the current
    weather and its two values, or an element of an hourly array), the fallback reading replaces all
    five values. A null inside an hourly array is a value, and stays null."""
    d = F.from_json("payload", S.WEATHER_FEED_SCHEMA)
    fb = S.WEATHER_FEED_FALLBACK
    hourly = {"humidity_pct": "relativehumidity_2m", "rainfall_mm": "precipitation", "pressure_hpa": "surface_pressure"}
    current = {"temperature_c": "temperature", "wind_speed_kmph": "windspeed"}
    parts = [F.col(f"d.current_weather.{c}").isNotNull() for c in current.values()]
    parts += [F.coalesce(F.size(f"d.hourly.{c}") > 0, F.lit(False)) for c in hourly.values()]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole & p
    values = {out: F.col(f"d.current_weather.{c}") for out, c in current.items()}
    values |= {out: F.get(F.col(f"d.hourly.{c}"), F.lit(0)) for out, c in hourly.items()}
    values["humidity_pct"] = values["humidity_pct"].cast("int")
    flat = polls.select("poll_id", "zone_name", "fetched_at", d.alias("d")).select(
        "poll_id", "zone_name", *[F.when(whole, v).otherwise(F.lit(fb[out])).alias(out) for out, v in values.items()],
        iso_text("fetched_at", FEED_TZ_SUFFIX).alias("timestamp"))
    return with_zone_attributes(flat, zones).select(
        "poll_id", sensor_id(S.WEATHER_TOPIC, "zone_name").alias("sensor_id"),
        F.col("zone_name").alias("zone"), F.col("zone_lat").alias("lat"),
        F.col("zone_lon").alias("lon"), "temperature_c", "wind_speed_kmph", "humidity_pct",
        "rainfall_mm", "pressure_hpa", "timestamp")
