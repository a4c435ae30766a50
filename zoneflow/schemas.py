"""Declared schemas, fixed labels and the zone dimension.

Everything here is data, declared once and shared by batch and streaming code.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# --- Fixed values (must equal the source application's for equal results) -------------------

# Message topics, one per feed.
AQI_TOPIC = "aqi-data"
TRAFFIC_TOPIC = "traffic-data"
WEATHER_TOPIC = "weather-data"
TOPICS = (AQI_TOPIC, TRAFFIC_TOPIC, WEATHER_TOPIC)

# Zone dimension: name, lat, lon, AQI modifier, free-flow speed (km/h), rush hours.
ZONES = (
    ("FC Road", 18.5236, 73.8478, 1.25, 40, (11, 12, 17, 18, 19)),
    ("Hadapsar", 18.5089, 73.9260, 1.35, 50, (8, 9, 17, 18)),
    ("Hinjewadi", 18.5912, 73.7389, 1.05, 50, (9, 10, 18, 19)),
    ("Kothrud", 18.5074, 73.8077, 0.85, 45, (9, 18)),
    ("Shivajinagar", 18.5308, 73.8474, 1.10, 35, (9, 10, 17, 18, 19)),
)
# Zones a unified document is emitted for (normalised: lower-case, trimmed).
EXPECTED_ZONES = ("fc road", "hadapsar", "hinjewadi", "kothrud", "shivajinagar")

# Status labels and thresholds.
AQI_HAZARDOUS, AQI_SEVERE, AQI_UNHEALTHY, AQI_ACCEPTABLE = (
    "Hazardous", "Severe", "Unhealthy", "Acceptable")
AQI_HAZARDOUS_ABOVE, AQI_SEVERE_ABOVE, AQI_UNHEALTHY_ABOVE = 300, 200, 100
AQI_ALERT_ABOVE = 200
TRAFFIC_BLOCKAGE, TRAFFIC_HEAVY, TRAFFIC_MODERATE, TRAFFIC_FREE = (
    "BLOCKAGE", "HEAVY CONGESTION", "MODERATE TRAFFIC", "FREE FLOW")
CONGESTION_HEAVY_ABOVE, CONGESTION_MODERATE_ABOVE = 60.0, 30.0
TRAFFIC_ALERT_SPEED_BELOW = 20.0
WEATHER_HEAVY_RAIN, WEATHER_EXTREME_HEAT, WEATHER_NORMAL = (
    "Heavy Rain", "Extreme Heat", "Normal")
HEAVY_RAIN_ABOVE_MM, EXTREME_HEAT_ABOVE_C = 5.0, 38.0
# City alerts.
ALERT_POLLUTION_TRAP = "🔴 POLLUTION TRAP"
ALERT_ROAD_CLOSED = "⚠️ ROAD CLOSED"
ALERT_ALL_CLEAR = "🟢 ALL CLEAR"
# Severity badge for an alert text.
SEVERITY_RED, SEVERITY_AMBER, SEVERITY_GREEN = "red", "amber", "green"

# Sensor id parts: prefix + upper(zone without spaces) + suffix.
SENSOR_PREFIX = {AQI_TOPIC: "AQI_", TRAFFIC_TOPIC: "TRF_", WEATHER_TOPIC: "WTR_"}
SENSOR_SUFFIX = "_001"

# Raw air-quality feed: defaults used when a field is missing.
AQI_FEED_DEFAULTS = {"aqi": 50, "pm25": 15, "pm10": 40, "no2": 12, "co": 4,
                     "t": 30, "h": 60, "w": 5}
# Raw air-quality feed: the whole baseline of a failed poll.
AQI_FEED_FAILED = {"aqi": 42, "pm25": 12, "pm10": 35, "no2": 15, "co": 5, "t": 31, "h": 55, "w": 8}
AQI_FEED_OK = "ok"
# Raw weather feed: fallback reading, as a whole.
WEATHER_FEED_FALLBACK = {"temperature_c": 32.0, "wind_speed_kmph": 10.0, "humidity_pct": 60,
                         "rainfall_mm": 0.0, "pressure_hpa": 1008.0}

# Local time zone of the documents: a zone-less time is read as local wall-clock time and its
# ISO text ends with this offset (the zone has kept one offset, without daylight saving, since 1945).
LOCAL_TIME_ZONE = "Asia/Kolkata"
LOCAL_UTC_OFFSET = "+05:30"
LOCAL_UTC_OFFSET_MINUTES = 330
# A date as the document store prints it in aggregation results (its default date format): UTC,
# milliseconds, "Z".
STORE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# Dashboard query bounds; LATEST_SCAN_LIMIT, TERMS_SIZE and ZONE_ANALYTICS_SIZE are the dashboard's
# own sizes, for callers that ask for them: no operator has them as a default.
RANGE_MINUTES_MIN, RANGE_MINUTES_MAX, RANGE_MINUTES_DEFAULT = 1, 1440, 60
LATEST_SCAN_LIMIT = 500
TERMS_SIZE = 10
ZONE_ANALYTICS_SIZE = 20
TREND_BUCKET = "30 seconds"
BATCH_LOOKBACK_MINUTES = 30

# --- Reading schemas (all fields nullable) --------------------------------------------------

AQI_SCHEMA = StructType([
    StructField("sensor_id", StringType()),
    StructField("zone", StringType()),
    StructField("lat", DoubleType()),
    StructField("lon", DoubleType()),
    StructField("aqi", IntegerType()),
    StructField("pm25", DoubleType()),
    StructField("pm10", DoubleType()),
    StructField("no2", DoubleType()),
    StructField("co", DoubleType()),
    StructField("temperature", DoubleType()),
    StructField("humidity", DoubleType()),
    StructField("wind", DoubleType()),
    StructField("timestamp", StringType()),
])

TRAFFIC_SCHEMA = StructType([
    StructField("sensor_id", StringType()),
    StructField("zone", StringType()),
    StructField("lat", DoubleType()),
    StructField("lon", DoubleType()),
    StructField("timestamp", StringType()),
    StructField("current_speed_kmph", DoubleType()),
    StructField("free_flow_speed", IntegerType()),
    StructField("congestion_pct", DoubleType()),
    StructField("road_closure", BooleanType()),
    StructField("data_source", StringType()),
])

WEATHER_SCHEMA = StructType([
    StructField("sensor_id", StringType()),
    StructField("zone", StringType()),
    StructField("lat", DoubleType()),
    StructField("lon", DoubleType()),
    StructField("temperature_c", DoubleType()),
    StructField("wind_speed_kmph", DoubleType()),
    StructField("humidity_pct", IntegerType()),
    StructField("rainfall_mm", DoubleType()),
    StructField("pressure_hpa", DoubleType()),
    StructField("timestamp", StringType()),
])

# Kafka-shaped message rows (the batch and streaming Kafka sources produce these columns).
MESSAGE_SCHEMA = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampNTZType()),
    StructField("timestampType", IntegerType()),
])

# Raw public-feed payloads (nested).
_V = StructType([StructField("v", DoubleType())])
AQI_FEED_DATA = StructType([
    StructField("aqi", IntegerType()),
    StructField("iaqi", StructType([StructField(m, _V) for m in
                                    ("pm25", "pm10", "no2", "co", "t", "h", "w")])),
    StructField("time", StructType([StructField("iso", StringType())])),
])
AQI_FEED_SCHEMA = StructType([
    StructField("status", StringType()),
    StructField("data", AQI_FEED_DATA),
])
WEATHER_FEED_SCHEMA = StructType([
    StructField("current_weather", StructType([
        StructField("temperature", DoubleType()),
        StructField("windspeed", DoubleType()),
    ])),
    StructField("hourly", StructType([
        StructField("relativehumidity_2m", ArrayType(DoubleType())),
        StructField("precipitation", ArrayType(DoubleType())),
        StructField("surface_pressure", ArrayType(DoubleType())),
    ])),
])

# --- Per-feed projection: (payload field, output column) ------------------------------------

FEED_SCHEMAS = {AQI_TOPIC: AQI_SCHEMA, TRAFFIC_TOPIC: TRAFFIC_SCHEMA, WEATHER_TOPIC: WEATHER_SCHEMA}
FEED_PREFIX = {AQI_TOPIC: "aqi", TRAFFIC_TOPIC: "traffic", WEATHER_TOPIC: "weather"}

FEED_COLUMNS = {
    AQI_TOPIC: [
        ("sensor_id", "aqi_sensor_id"), ("zone", "zone"), ("lat", "aqi_lat"),
        ("lon", "aqi_lon"), ("aqi", "aqi"), ("pm25", "pm25"), ("pm10", "pm10"),
        ("no2", "no2"), ("co", "co"), ("temperature", "aqi_temperature"),
        ("humidity", "aqi_humidity"), ("wind", "aqi_wind"),
        ("timestamp", "aqi_source_timestamp"),
    ],
    TRAFFIC_TOPIC: [
        ("sensor_id", "traffic_sensor_id"), ("zone", "traffic_zone"), ("lat", "traffic_lat"),
        ("lon", "traffic_lon"), ("timestamp", "traffic_source_timestamp"),
        ("current_speed_kmph", "current_speed_kmph"), ("free_flow_speed", "free_flow_speed"),
        ("congestion_pct", "congestion_pct"), ("road_closure", "road_closure"),
        ("data_source", "traffic_data_source"),
    ],
    WEATHER_TOPIC: [
        ("sensor_id", "weather_sensor_id"), ("zone", "weather_zone"), ("lat", "weather_lat"),
        ("lon", "weather_lon"), ("temperature_c", "temperature_c"),
        ("wind_speed_kmph", "wind_speed_kmph"), ("humidity_pct", "humidity_pct"),
        ("rainfall_mm", "rainfall_mm"), ("pressure_hpa", "pressure_hpa"),
        ("timestamp", "weather_source_timestamp"),
    ],
}

# The unified document, 41 columns in order.
UNIFIED_COLUMNS = [
    "zone", "synchronized_time",
    "aqi_sensor_id", "aqi_lat", "aqi_lon", "aqi_source_timestamp",
    "aqi_kafka_time", "aqi", "aqi_status", "pm25", "pm10", "no2",
    "co", "aqi_temperature", "aqi_humidity", "aqi_wind",
    "traffic_sensor_id", "traffic_zone", "traffic_lat", "traffic_lon",
    "traffic_source_timestamp", "traffic_kafka_time",
    "current_speed_kmph", "free_flow_speed", "congestion_pct",
    "road_closure", "traffic_data_source", "traffic_status",
    "weather_sensor_id", "weather_zone", "weather_lat", "weather_lon",
    "weather_source_timestamp", "weather_kafka_time",
    "temperature_c", "wind_speed_kmph", "humidity_pct", "rainfall_mm",
    "pressure_hpa", "weather_condition", "city_alert",
]

_TYPES = {out: FEED_SCHEMAS[t][src].dataType for t, fields in FEED_COLUMNS.items() for src, out in fields}
# The same as a schema, for document tables that have no file yet.
UNIFIED_SCHEMA = StructType([
    StructField(c, _TYPES.get(c) or (TimestampNTZType() if c.endswith("_time") else StringType()))
    for c in UNIFIED_COLUMNS])
