"""DuckDB twins of the registered queries (the correctness oracle).

Written independently of the Spark plans: the adapter is recomputed from ``events`` column by
column, "latest" is a row_number per group, and the history replay is a brute-force as-of join
(every (zone, tick) pair against every earlier reading). Fine at the check's scale factor.
"""

from __future__ import annotations

from zoneflow import schemas as S
from zoneflow.plans.params import AS_OF, TICK_SECONDS

AS_OF_SQL = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"


def _zone_values() -> str:
    rows = [f"({i}, '{name}', {lat}::DOUBLE, {lon}::DOUBLE, {mod}::DOUBLE, {ff}, "
            f"[{', '.join(str(h) for h in rush)}])"
            for i, (name, lat, lon, mod, ff, rush) in enumerate(S.ZONES)]
    return ",\n    ".join(rows)


ZONE_TEXT = "CASE WHEN ev.user_id % 10 >= 5 THEN ' ' || upper(zd.zone_name) || ' ' ELSE zd.zone_name END"

# Messages rebuilt from events (FIXTURES.md §7): one CTE chain, prefixed to every query.
BASE = f"""
zd(zi, zone_name, lat, lon, aqi_modifier, free_flow, rush_hours) AS (VALUES
    {_zone_values()}
),
ev AS (
  SELECT e.*, CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k FROM events e
),
msg AS (
  SELECT
    CASE ev.event_id % 3 WHEN 0 THEN '{S.AQI_TOPIC}' WHEN 1 THEN '{S.TRAFFIC_TOPIC}'
         ELSE '{S.WEATHER_TOPIC}' END AS topic,
    ev.ts AS kafka_time, 0 AS kafka_partition, ev.event_id AS kafka_offset,
    ev.k, ev.event_type, ev.value, ev.user_id, ev.ts,
    zd.zone_name, zd.lat, zd.lon, zd.aqi_modifier, zd.free_flow, zd.rush_hours,
    {ZONE_TEXT} AS zone_text,
    strftime(ev.ts, '%Y-%m-%dT%H:%M:%S') AS ts_text,
    upper(replace(zd.zone_name, ' ', '')) AS sensor_zone
  FROM ev JOIN zd ON zd.zi = ev.user_id % 5
),
msg_json AS (
  SELECT topic, kafka_time, kafka_partition, kafka_offset,
    CASE topic
      WHEN '{S.AQI_TOPIC}' THEN json_object(
        'sensor_id', 'AQI_' || sensor_zone || '_001', 'zone', zone_text, 'lat', lat, 'lon', lon,
        'aqi', k * 4, 'pm25', CAST(k AS DOUBLE) / 2, 'pm10', CAST(k AS DOUBLE),
        'no2', CAST(k AS DOUBLE) / 4, 'co', CAST(k AS DOUBLE) / 8,
        'temperature', CAST(k AS DOUBLE) / 4 + 20, 'humidity', CAST(k AS DOUBLE),
        'wind', value, 'timestamp', ts_text)::VARCHAR
      WHEN '{S.TRAFFIC_TOPIC}' THEN json_object(
        'sensor_id', 'TRF_' || sensor_zone || '_001', 'zone', zone_text, 'lat', lat, 'lon', lon,
        'timestamp', ts_text, 'current_speed_kmph', 50.0::DOUBLE - CAST(k AS DOUBLE) / 2,
        'free_flow_speed', 50, 'congestion_pct', CAST(k AS DOUBLE),
        'road_closure', event_type = 'error', 'data_source', 'fixture')::VARCHAR
      ELSE json_object(
        'sensor_id', 'WTR_' || sensor_zone || '_001', 'zone', zone_text, 'lat', lat, 'lon', lon,
        'temperature_c', CAST(k AS DOUBLE) / 4 + 20, 'wind_speed_kmph', value,
        'humidity_pct', k, 'rainfall_mm', CAST(k AS DOUBLE) / 16,
        'pressure_hpa', CAST(k AS DOUBLE) / 4 + 1000, 'timestamp', ts_text)::VARCHAR
    END AS json_payload
  FROM msg
),
aqi_r AS (
  SELECT lower(trim(zone_text)) AS norm_zone, 'AQI_' || sensor_zone || '_001' AS aqi_sensor_id,
    zone_text AS zone, lat AS aqi_lat, lon AS aqi_lon, k * 4 AS aqi,
    CAST(k AS DOUBLE) / 2 AS pm25, CAST(k AS DOUBLE) AS pm10, CAST(k AS DOUBLE) / 4 AS no2,
    CAST(k AS DOUBLE) / 8 AS co, CAST(k AS DOUBLE) / 4 + 20 AS aqi_temperature,
    CAST(k AS DOUBLE) AS aqi_humidity, value AS aqi_wind, ts_text AS aqi_source_timestamp,
    kafka_time AS aqi_kafka_time, kafka_partition AS aqi_kafka_partition,
    kafka_offset AS aqi_kafka_offset
  FROM msg WHERE topic = '{S.AQI_TOPIC}'
),
traffic_r AS (
  SELECT lower(trim(zone_text)) AS norm_zone, 'TRF_' || sensor_zone || '_001' AS traffic_sensor_id,
    zone_text AS traffic_zone, lat AS traffic_lat, lon AS traffic_lon,
    ts_text AS traffic_source_timestamp, 50.0::DOUBLE - CAST(k AS DOUBLE) / 2 AS current_speed_kmph,
    50 AS free_flow_speed, CAST(k AS DOUBLE) AS congestion_pct,
    event_type = 'error' AS road_closure, 'fixture' AS traffic_data_source,
    kafka_time AS traffic_kafka_time, kafka_partition AS traffic_kafka_partition,
    kafka_offset AS traffic_kafka_offset
  FROM msg WHERE topic = '{S.TRAFFIC_TOPIC}'
),
weather_r AS (
  SELECT lower(trim(zone_text)) AS norm_zone, 'WTR_' || sensor_zone || '_001' AS weather_sensor_id,
    zone_text AS weather_zone, lat AS weather_lat, lon AS weather_lon,
    CAST(k AS DOUBLE) / 4 + 20 AS temperature_c, value AS wind_speed_kmph, k AS humidity_pct,
    CAST(k AS DOUBLE) / 16 AS rainfall_mm, CAST(k AS DOUBLE) / 4 + 1000 AS pressure_hpa,
    ts_text AS weather_source_timestamp,
    kafka_time AS weather_kafka_time, kafka_partition AS weather_kafka_partition,
    kafka_offset AS weather_kafka_offset
  FROM msg WHERE topic = '{S.WEATHER_TOPIC}'
)"""

AQI_COLS = ("norm_zone, aqi_sensor_id, zone, aqi_lat, aqi_lon, aqi, pm25, pm10, no2, co, "
            "aqi_temperature, aqi_humidity, aqi_wind, aqi_source_timestamp, aqi_kafka_time, "
            "aqi_kafka_partition, aqi_kafka_offset")
TRAFFIC_COLS = ("norm_zone, traffic_sensor_id, traffic_zone, traffic_lat, traffic_lon, "
                "traffic_source_timestamp, current_speed_kmph, free_flow_speed, congestion_pct, "
                "road_closure, traffic_data_source, traffic_kafka_time, traffic_kafka_partition, "
                "traffic_kafka_offset")
WEATHER_COLS = ("norm_zone, weather_sensor_id, weather_zone, weather_lat, weather_lon, "
                "temperature_c, wind_speed_kmph, humidity_pct, rainfall_mm, pressure_hpa, "
                "weather_source_timestamp, weather_kafka_time, weather_kafka_partition, "
                "weather_kafka_offset")

AQI_STATUS = f"""CASE WHEN aqi > {S.AQI_HAZARDOUS_ABOVE} THEN '{S.AQI_HAZARDOUS}'
  WHEN aqi > {S.AQI_SEVERE_ABOVE} THEN '{S.AQI_SEVERE}'
  WHEN aqi > {S.AQI_UNHEALTHY_ABOVE} THEN '{S.AQI_UNHEALTHY}' ELSE '{S.AQI_ACCEPTABLE}' END"""
TRAFFIC_STATUS = f"""CASE WHEN road_closure THEN '{S.TRAFFIC_BLOCKAGE}'
  WHEN congestion_pct > 60 THEN '{S.TRAFFIC_HEAVY}'
  WHEN congestion_pct > 30 THEN '{S.TRAFFIC_MODERATE}' ELSE '{S.TRAFFIC_FREE}' END"""
WEATHER_CONDITION = f"""CASE WHEN rainfall_mm > 5 THEN '{S.WEATHER_HEAVY_RAIN}'
  WHEN temperature_c > 38 THEN '{S.WEATHER_EXTREME_HEAT}' ELSE '{S.WEATHER_NORMAL}' END"""
CITY_ALERT = f"""CASE WHEN aqi > 200 AND congestion_pct > 60 THEN '{S.ALERT_POLLUTION_TRAP}'
  WHEN road_closure THEN '{S.ALERT_ROAD_CLOSED}' ELSE '{S.ALERT_ALL_CLEAR}' END"""

UNIFIED_SELECT = f"""zone, synchronized_time, aqi_sensor_id, aqi_lat, aqi_lon, aqi_source_timestamp,
  aqi_kafka_time, aqi, {AQI_STATUS} AS aqi_status, pm25, pm10, no2, co, aqi_temperature,
  aqi_humidity, aqi_wind, traffic_sensor_id, traffic_zone, traffic_lat, traffic_lon,
  traffic_source_timestamp, traffic_kafka_time, current_speed_kmph, free_flow_speed,
  congestion_pct, road_closure, traffic_data_source, {TRAFFIC_STATUS} AS traffic_status,
  weather_sensor_id, weather_zone, weather_lat, weather_lon, weather_source_timestamp,
  weather_kafka_time, temperature_c, wind_speed_kmph, humidity_pct, rainfall_mm, pressure_hpa,
  {WEATHER_CONDITION} AS weather_condition, {CITY_ALERT} AS city_alert"""


def _latest(feed: str, prefix: str, cols: str, where: str = "TRUE") -> str:
    return f"""SELECT {cols} FROM (
    SELECT *, row_number() OVER (PARTITION BY norm_zone ORDER BY {prefix}_kafka_time DESC,
      {prefix}_kafka_partition DESC, {prefix}_kafka_offset DESC) AS rn
    FROM {feed} WHERE norm_zone IS NOT NULL AND norm_zone <> '' AND {where}) t WHERE rn = 1"""


def latest_ctes(where_time: str = "TRUE") -> str:
    w = {p: where_time.replace("kafka_time", f"{p}_kafka_time") for p in ("aqi", "traffic", "weather")}
    return f""",
aqi_l AS ({_latest('aqi_r', 'aqi', AQI_COLS, w['aqi'])}),
traffic_l AS ({_latest('traffic_r', 'traffic', TRAFFIC_COLS, w['traffic'])}),
weather_l AS ({_latest('weather_r', 'weather', WEATHER_COLS, w['weather'])}),
joined AS (
  SELECT * FROM aqi_l JOIN traffic_l USING (norm_zone) JOIN weather_l USING (norm_zone)
)"""


# Brute-force history: every (zone, tick) against every reading before the tick end.
def history_ctes() -> str:
    tick = f"INTERVAL {TICK_SECONDS} SECOND"
    def asof(feed: str, prefix: str, cols: str) -> str:
        return f"""SELECT * EXCLUDE (rn) FROM (
    SELECT g.synchronized_time, f.*, row_number() OVER (
      PARTITION BY g.norm_zone, g.synchronized_time
      ORDER BY f.{prefix}_kafka_time DESC, f.{prefix}_kafka_partition DESC,
               f.{prefix}_kafka_offset DESC) AS rn
    FROM grid g JOIN {feed} f ON f.norm_zone = g.norm_zone
      AND f.{prefix}_kafka_time < g.synchronized_time) t WHERE rn = 1"""
    return f""",
ticks AS (
  SELECT DISTINCT time_bucket({tick}, kafka_time) + {tick} AS synchronized_time
  FROM msg WHERE kafka_time < {AS_OF_SQL}
),
zones AS (
  SELECT DISTINCT norm_zone FROM (
    SELECT norm_zone FROM aqi_r UNION ALL SELECT norm_zone FROM traffic_r
    UNION ALL SELECT norm_zone FROM weather_r) z
  WHERE norm_zone IS NOT NULL AND norm_zone <> ''
),
grid AS (
  SELECT z.norm_zone, t.synchronized_time FROM zones z, ticks t
  WHERE t.synchronized_time <= {AS_OF_SQL}
),
aqi_h AS ({asof('aqi_r', 'aqi', AQI_COLS)}),
traffic_h AS ({asof('traffic_r', 'traffic', TRAFFIC_COLS)}),
weather_h AS ({asof('weather_r', 'weather', WEATHER_COLS)}),
history AS (
  SELECT {UNIFIED_SELECT}
  FROM aqi_h JOIN traffic_h USING (norm_zone, synchronized_time)
    JOIN weather_h USING (norm_zone, synchronized_time)
)"""


def with_base(body: str, *extra: str) -> str:
    return "WITH " + BASE + "".join(extra) + "\n" + body


def store_time_sql(expr: str) -> str:
    """AG-11 in DuckDB: local wall-clock time shifted to UTC by the zone's fixed offset."""
    return (f"strftime({expr} - INTERVAL {S.LOCAL_UTC_OFFSET_MINUTES} MINUTE, "
            "'%Y-%m-%dT%H:%M:%S.%g') || 'Z'")


def doc_time_sql(col: str) -> str:
    """SC-08 in DuckDB: ISO seconds, ``.ffffff`` only when the microseconds are not zero, offset."""
    return (f"(strftime({col}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({col}, '%f') <> '000000' "
            f"THEN '.' || strftime({col}, '%f') ELSE '' END || '{S.LOCAL_UTC_OFFSET}')")


DOC_ID = f"zone || '-' || {doc_time_sql('synchronized_time')}"


def rendered_documents_sql() -> str:
    """SNK-04 in DuckDB: the key and the JSON document, timestamps as document text, nulls kept."""
    stamps = ("synchronized_time", "aqi_kafka_time", "traffic_kafka_time", "weather_kafka_time")
    replace = ", ".join(f"{doc_time_sql(c)} AS {c}" for c in stamps)
    # synchronized_time is already document text in d
    return with_base("SELECT zone || '-' || synchronized_time AS doc_id, "
                     "CAST(to_json(d) AS VARCHAR) AS document FROM "
                     f"(SELECT * REPLACE ({replace}) FROM history) d", history_ctes())


def range_filter(minutes: int) -> str:
    return (f"synchronized_time BETWEEN {AS_OF_SQL} - INTERVAL {minutes} MINUTE "
            f"AND {AS_OF_SQL}")


TRAP = f"'{S.ALERT_POLLUTION_TRAP}'"


def r1(expr: str) -> str:
    """One-decimal half-up rounding of a double's shortest decimal text (Spark's ``round``).

    DuckDB's double ``round`` works on the scaled binary value, so for 9 * 0.85 =
    7.6499999999999995 it gives 7.7 where Spark (and Python) give 7.6.
    """
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 20)), 1) AS DOUBLE)"


def _map_of(column: str) -> str:
    return (f"(SELECT map_from_entries(list({{'k': name, 'v': n}} ORDER BY name)) FROM (SELECT {column} AS name, "
            f"CAST(count(*) AS BIGINT) AS n FROM h WHERE {column} IS NOT NULL GROUP BY 1) c)")


def summary_sql(minutes: int) -> str:
    return with_base(f"""SELECT
  CAST(count(DISTINCT zone) AS BIGINT) AS zone_count,
  CAST(count(aqi) AS BIGINT) AS record_count,
  round(avg(aqi), 1) AS avg_aqi,
  round(CAST(max(aqi) AS DOUBLE), 1) AS max_aqi,
  round(avg(congestion_pct), 1) AS avg_congestion,
  round(avg(temperature_c), 1) AS avg_temperature,
  CAST(count_if(city_alert = {TRAP}) AS BIGINT) AS pollution_trap_count,
  CAST(count_if(road_closure) AS BIGINT) AS road_closure_count,
  {store_time_sql('max(synchronized_time)')} AS last_updated,
  {_map_of('city_alert')} AS alerts, {_map_of('aqi_status')} AS aqi_statuses,
  {_map_of('traffic_status')} AS traffic_statuses
FROM h""", history_ctes(), _ranged(minutes))


def zone_analytics_sql(minutes: int) -> str:
    return with_base(f"""SELECT zone,
  CAST(count(*) AS BIGINT) AS record_count,
  round(avg(aqi), 1) AS avg_aqi,
  round(CAST(max(aqi) AS DOUBLE), 1) AS max_aqi,
  round(avg(congestion_pct), 1) AS avg_congestion,
  round(max(congestion_pct), 1) AS max_congestion,
  round(avg(current_speed_kmph), 1) AS avg_speed,
  round(avg(temperature_c), 1) AS avg_temperature,
  round(avg(humidity_pct), 1) AS avg_humidity,
  round(coalesce(sum(rainfall_mm), 0.0), 1) AS total_rainfall,
  CAST(count_if(city_alert = {TRAP}) AS BIGINT) AS pollution_trap_count,
  CAST(count_if(road_closure) AS BIGINT) AS road_closure_count
FROM history WHERE {range_filter(minutes)} AND zone IS NOT NULL
GROUP BY zone ORDER BY zone""", history_ctes())


_RANKED_STATUS_COUNTS = f"""(
  SELECT dimension, name, value,
    CAST(row_number() OVER (PARTITION BY dimension ORDER BY value DESC, name) AS INTEGER) AS rank
  FROM (
    SELECT dimension, name, CAST(count(*) AS BIGINT) AS value FROM (
      SELECT 'alerts' AS dimension, city_alert AS name FROM h
      UNION ALL SELECT 'aqi_statuses', aqi_status FROM h
      UNION ALL SELECT 'traffic_statuses', traffic_status FROM h
      UNION ALL SELECT 'weather_conditions', weather_condition FROM h) s
    WHERE name IS NOT NULL GROUP BY dimension, name) c) r
WHERE rank <= {S.TERMS_SIZE}"""


def _ranged(minutes: int) -> str:
    return f",\nh AS (SELECT * FROM history WHERE {range_filter(minutes)})"


def status_breakdown_sql(minutes: int) -> str:
    return with_base(f"SELECT dimension, name, value, rank FROM {_RANKED_STATUS_COUNTS}",
                     history_ctes(), _ranged(minutes))


def summary_maps_sql(minutes: int) -> str:
    """AG-08: the alert / AQI / traffic value -> count maps of the summary (all values)."""
    return with_base(
        "SELECT dimension, map_from_entries(list({'k': name, 'v': value} ORDER BY name)) AS counts "
        f"FROM {_RANKED_STATUS_COUNTS.partition('WHERE rank')[0]} WHERE dimension <> 'weather_conditions' GROUP BY dimension",
        history_ctes(), _ranged(minutes))


def trends_sql(minutes: int) -> str:
    return with_base(f"""SELECT {store_time_sql('time_bucket(INTERVAL 30 SECOND, synchronized_time)')} AS time,
  CAST(count(*) AS BIGINT) AS record_count,
  round(avg(aqi), 1) AS avg_aqi,
  round(avg(congestion_pct), 1) AS avg_congestion,
  round(avg(current_speed_kmph), 1) AS avg_speed,
  round(avg(temperature_c), 1) AS avg_temperature,
  CAST(count_if(city_alert = {TRAP}) AS BIGINT) AS pollution_trap_count
FROM history WHERE {range_filter(minutes)}
GROUP BY 1 ORDER BY 1""", history_ctes())


def latest_docs_sql(minutes: int) -> str:
    return with_base(f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY zone ORDER BY synchronized_time DESC) AS rn
  FROM history WHERE {range_filter(minutes)}
    AND zone IS NOT NULL AND zone <> '') t WHERE rn = 1""", history_ctes())
