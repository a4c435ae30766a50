"""Deterministic adapter from the driver's ``events`` table to Kafka-shaped messages.

Each event becomes one message on one of the three topics. The rule (see FIXTURES.md §7) is plain
column arithmetic, so it runs as one projection with no shuffle, in batch or streaming plans, and
an equivalent DuckDB query can be written for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow import schemas as S
from zoneflow.functions.text import iso_text
from zoneflow.sources.feeds import FEED_TZ_SUFFIX

_K_SQL = "try_cast(get_json_object(props, '$.k') AS INT)"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _zone_array_sql() -> str:
    """The zone dimension as one SQL array literal of structs (name, lat, lon, aqi_modifier,
    free_flow, rush_hours), built from ``schemas.ZONES``."""
    def one(name, lat, lon, mod, ff, rush):
        return (f"named_struct('name', '{name}', 'lat', {lat}D, 'lon', {lon}D, "
                f"'aqi_modifier', {mod}D, 'free_flow', {ff}, "
                f"'rush_hours', array({', '.join(str(h) for h in rush)}))")
    return "array(" + ", ".join(one(*z) for z in S.ZONES) + ")"


_ZONE_ARRAY_SQL = _zone_array_sql()


def zone_lookup(idx: Column) -> Column:
    """The zone-dimension struct (name, lat, lon, aqi_modifier, free_flow, rush_hours) at ``idx``.

    A literal array of five structs: a per-row lookup in generated code, no join. It is given as
    one SQL expression, so building it is one call to the JVM rather than one per field.
    """
    return F.element_at(F.expr(_ZONE_ARRAY_SQL), (idx + 1).cast("int"))


def _sensor_id_sql(topic: str, name: str) -> str:
    """SC-12 as SQL text (the same rule as ``functions.text.sensor_id``)."""
    return f"concat('{S.SENSOR_PREFIX[topic]}', upper(replace({name}, ' ', '')), '{S.SENSOR_SUFFIX}')"


def _payload_sql(zone_text: str) -> str:
    """The JSON payload of each message as one SQL expression over ``_k``, ``_zone`` and the
    event's columns: the topic slot (``event_id % 3``) picks the feed, and each feed's fields
    are plain arithmetic on k (FIXTURES.md §7)."""
    name = "_zone.name"
    ts_text = "date_format(ts, 'yyyy-MM-dd\\'T\\'HH:mm:ss')"
    k = "CAST(_k AS DOUBLE)"
    quarter = f"{k} / 4"
    aqi = [("sensor_id", _sensor_id_sql(S.AQI_TOPIC, name)), ("zone", zone_text),
           ("lat", "_zone.lat"), ("lon", "_zone.lon"), ("aqi", "_k * 4"), ("pm25", f"{k} / 2"),
           ("pm10", k), ("no2", quarter), ("co", f"{k} / 8"), ("temperature", f"{quarter} + 20"),
           ("humidity", k), ("wind", "value"), ("timestamp", ts_text)]
    traffic = [("sensor_id", _sensor_id_sql(S.TRAFFIC_TOPIC, name)), ("zone", zone_text),
               ("lat", "_zone.lat"), ("lon", "_zone.lon"), ("timestamp", ts_text),
               ("current_speed_kmph", f"50.0D - {k} / 2"), ("free_flow_speed", "50"),
               ("congestion_pct", k), ("road_closure", "event_type = 'error'"),
               ("data_source", "'fixture'")]
    weather = [("sensor_id", _sensor_id_sql(S.WEATHER_TOPIC, name)), ("zone", zone_text),
               ("lat", "_zone.lat"), ("lon", "_zone.lon"), ("temperature_c", f"{quarter} + 20"),
               ("wind_speed_kmph", "value"), ("humidity_pct", "_k"), ("rainfall_mm", f"{k} / 16"),
               ("pressure_hpa", f"{quarter} + 1000"), ("timestamp", ts_text)]

    def json(fields):
        return "to_json(named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields) + "))"
    return (f"CASE event_id % 3 WHEN 0 THEN {json(aqi)} WHEN 1 THEN {json(traffic)} "
            f"ELSE {json(weather)} END")


_PAYLOAD_SQL = _payload_sql("CASE WHEN user_id % 10 >= 5 THEN concat(' ', upper(_zone.name), ' ') ELSE _zone.name END")
_WIDE_PAYLOAD_SQL = _payload_sql("concat('User ', user_id)")
_TOPIC_SQL = (f"CASE event_id % 3 WHEN 0 THEN '{S.AQI_TOPIC}' WHEN 1 THEN '{S.TRAFFIC_TOPIC}' "
              f"ELSE '{S.WEATHER_TOPIC}' END")


def events_to_messages(events: DataFrame, keep_k: bool = False, wide: bool = False) -> DataFrame:
    """Kafka-shaped rows: key, value, topic, partition, offset, timestamp, timestampType
    (and the event's ``_k`` when ``keep_k``).

    Two projections given as SQL text (one call to the JVM each, not one per field): k and the
    zone are computed once per row, then every payload field reads them. ``wide``: every user is a
    zone of its own (many zones; coordinates and sensor ids stay those of the five)."""
    events = events.selectExpr(
        "event_id", "ts", "user_id", "event_type", "value",
        f"{_K_SQL} AS _k",
        f"element_at({_ZONE_ARRAY_SQL}, CAST(user_id % 5 + 1 AS INT)) AS _zone")
    return events.selectExpr(
        "CAST(NULL AS BINARY) AS key",
        f"encode({_WIDE_PAYLOAD_SQL if wide else _PAYLOAD_SQL}, 'UTF-8') AS value",
        f"{_TOPIC_SQL} AS topic",
        "0 AS `partition`",
        "event_id AS `offset`",
        "ts AS `timestamp`",
        "0 AS timestampType",
        *(["_k"] if keep_k else []),
    )


# Fixed defect classes of the noisy topic, chosen by k mod 10 of each event.
DEFECT_TRUNCATED, DEFECT_BLANK_ZONE, DEFECT_BAD_TYPE, DEFECT_UNKNOWN_TOPIC = 1, 2, 3, 4
UNKNOWN_TOPIC = "unknown-data"


def noisy_messages(events: DataFrame) -> DataFrame:
    """The same messages with deterministic defects, for the reject report (PRJ-08, SNK-06):
    by ``k mod 10`` of each event, 1 cuts the payload short (malformed JSON), 2 blanks the zone,
    3 writes the latitude as text (a field of the wrong type), 4 moves the message to an
    unknown topic; every other message is unchanged. No message is dropped."""
    m = events_to_messages(events, keep_k=True)
    v = F.col("value").cast("string")
    d = F.col("_k") % 10
    text = (F.when(d == DEFECT_TRUNCATED, F.expr("substring(value, 1, length(value) - 1)"))
            .when(d == DEFECT_BLANK_ZONE,
                  F.regexp_replace(v, '"zone":"[^"]*"', '"zone":"  "'))
            .when(d == DEFECT_BAD_TYPE, F.regexp_replace(v, '"lat":[-0-9.]+', '"lat":"north"'))
            .otherwise(v))
    topic = F.when(d == DEFECT_UNKNOWN_TOPIC, F.lit(UNKNOWN_TOPIC)).otherwise(F.col("topic"))
    return m.select("key", F.encode(text, "UTF-8").alias("value"), topic.alias("topic"),
                    "partition", "offset", "timestamp", "timestampType")


def read_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch stand-in for a bounded Kafka read over all three topics."""
    return events_to_messages(read_events(spark, sf_dir))


def read_event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over ``events.parquet``."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    reader = (spark.readStream.schema(schema)
              .option("pathGlobFilter", "events.parquet"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(sf_dir)


def read_message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming stand-in: the events' stream turned into messages."""
    return events_to_messages(read_event_stream(spark, sf_dir))


def read_message_files_stream(spark: SparkSession, path: str) -> DataFrame:
    """Streaming stand-in for a topic landed as Parquet files with the Kafka columns
    (see ``sinks.publish.write_message_files``)."""
    return spark.readStream.schema(S.MESSAGE_SCHEMA).parquet(path)


def raw_aqi_polls(events: DataFrame) -> DataFrame:
    """(poll_id, fetched_at, payload): a city-wide air-quality answer per event.

    Answers come in the service's envelope. ``signup`` polls lack the index and ``view`` polls lack
    NO2 and wind; ``error`` polls are failed ones: an error status, and no envelope at all where k is
    odd. Null fields are left out of the JSON text.
    """
    k = F.col("_k").cast("double")
    et = F.col("event_type")
    v = lambda c: F.struct(c.alias("v"))
    payload = F.struct(
        F.when(et != "signup", F.col("_k") * 4).alias("aqi"),
        F.struct(v(k / 2).alias("pm25"), v(k).alias("pm10"),
                 F.when(et != "view", v(k / 4)).alias("no2"), v(k / 8).alias("co"),
                 v(k / 4 + 20).alias("t"), v(k).alias("h"),
                 F.when(et != "view", v(F.col("value"))).alias("w")).alias("iaqi"),
        F.struct(iso_text("ts", FEED_TZ_SUFFIX).alias("iso")).alias("time"),
    )
    status = F.when(et == "error", "error").otherwise(S.AQI_FEED_OK)
    answer = F.when((et == "error") & (F.col("_k") % 2 == 1), F.to_json(payload)).otherwise(
        F.to_json(F.struct(status.alias("status"), payload.alias("data"))))
    return (events.select("event_id", "ts", "event_type", "value", F.expr(_K_SQL).alias("_k"))
            .select(F.col("event_id").alias("poll_id"), F.col("ts").alias("fetched_at"),
                    answer.alias("payload")))


def raw_weather_polls(events: DataFrame) -> DataFrame:
    """(poll_id, zone_name, fetched_at, payload): one weather answer per event, for the zone of
    the event's user. ``error`` polls are failed fetches (empty object); ``signup`` polls have
    empty hourly arrays."""
    k = F.col("_k").cast("double")
    et = F.col("event_type")
    hourly = F.when(et == "signup", F.struct(
        F.array().cast("array<double>").alias("relativehumidity_2m"),
        F.array().cast("array<double>").alias("precipitation"),
        F.array().cast("array<double>").alias("surface_pressure"))).otherwise(F.struct(
            F.array(k, k + 1).alias("relativehumidity_2m"),
            F.array(k / 16, F.lit(0.0)).alias("precipitation"),
            F.array(k / 4 + 1000, F.lit(1000.0)).alias("surface_pressure")))
    payload = F.when(et == "error", F.lit("{}")).otherwise(F.to_json(F.struct(
        F.struct((k / 4 + 20).alias("temperature"), F.col("value").alias("windspeed"))
        .alias("current_weather"),
        hourly.alias("hourly"))))
    return (events.select("event_id", "ts", "event_type", "value", "user_id", F.expr(_K_SQL).alias("_k"))
            .select(F.col("event_id").alias("poll_id"),
                    zone_lookup(F.col("user_id") % 5)["name"].alias("zone_name"),
                    F.col("ts").alias("fetched_at"), payload.alias("payload")))
