"""
user runs (§2.12). Each takes (spark, sf_dir) and reads the driver's tables; its DuckDB twin is in
``SQL`` under the same key.

Keys are the inventory id plus a short name; composites use their own names.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow import schemas as S
from zoneflow.functions.times import ntz
from zoneflow.operators import history as H
from zoneflow.operators import latest as L
from zoneflow.operators import metrics as M
from zoneflow.operators import parse as P
from zoneflow.operators import unify as U
from zoneflow.plans import oracle as O
from zoneflow.plans.params import AS_OF, RANGE_LONG, RANGE_RAGGED, RANGE_SHORT, TICK
from zoneflow.plans import fixtures
from zoneflow.sources import kafka as K
from zoneflow.streaming import tagging as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped messages derived from the driver's ``events`` table."""
    return fixtures.read_messages(spark, sf_dir)


def message_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.message_columns(messages(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str, minutes: int | None = None) -> DataFrame:
    """JN-03: the unified-document history as of ``AS_OF`` with hourly ticks; of the last ``minutes``
    if given (older messages then only count into the state that is carried in)."""
    since = None if minutes is None else AS_OF - dt.timedelta(minutes=minutes)
    return H.replay_history(message_cols(spark, sf_dir), AS_OF, tick=TICK, since=since)



@register("unified_snapshot", O.with_base(
    f"SELECT {O.UNIFIED_SELECT} FROM (SELECT *, TIMESTAMP '2024-01-31 00:00:00' AS "
    "synchronized_time FROM joined) j ORDER BY zone", O.latest_ctes()))
def unified_snapshot(spark, sf_dir):
    return U.unified_snapshot(message_cols(spark, sf_dir), AS_OF)


@register("latest", O.latest_docs_sql(RANGE_SHORT))
def latest(spark, sf_dir):
    return M.latest_documents(history(spark, sf_dir, RANGE_SHORT), AS_OF, RANGE_SHORT)


@register("summary", O.summary_sql(RANGE_SHORT))
def summary(spark, sf_dir):
    return M.summary(history(spark, sf_dir, RANGE_SHORT), AS_OF, RANGE_SHORT)


@register("zone_analytics", O.zone_analytics_sql(RANGE_SHORT))
def zone_analytics(spark, sf_dir):
    return M.zone_analytics(history(spark, sf_dir, RANGE_SHORT), AS_OF, RANGE_SHORT)


@register("status_breakdown", O.status_breakdown_sql(RANGE_SHORT))
def status_breakdown(spark, sf_dir):
    return M.status_breakdown(history(spark, sf_dir, RANGE_SHORT), AS_OF, RANGE_SHORT)


@register("trends", O.trends_sql(RANGE_SHORT))
def trends(spark, sf_dir):
    return M.trends(history(spark, sf_dir, RANGE_SHORT), AS_OF, RANGE_SHORT)


# --- 2.1 sources ----------------------------------------------------------------------------

@register("src_01_multi_topic_source", O.with_base(
    "SELECT topic, json_payload, kafka_time, kafka_partition, kafka_offset FROM msg_json"))
def src_01(spark, sf_dir):
    return message_cols(spark, sf_dir)


@register("src_02_single_topic_source", O.with_base(
    "SELECT topic, json_payload, kafka_time, kafka_partition, kafka_offset FROM msg_json "
    f"WHERE topic = '{S.AQI_TOPIC}'"))
def src_02(spark, sf_dir):
    return K.message_columns(K.single_topic(messages(spark, sf_dir), S.AQI_TOPIC))


@register("src_03_bounded_read", O.with_base(
    "SELECT topic, kafka_partition AS partition, kafka_offset AS \"offset\", "
    "kafka_time AS \"timestamp\", CAST(NULL AS VARCHAR) AS key, json_payload AS value "
    "FROM msg_json"))
def src_03(spark, sf_dir):
    # earliest -> latest: the whole landed range
    return K.decode_messages(K.within_offsets(messages(spark, sf_dir), starting=0))


@register("src_04_lookback_range", O.with_base(
    "SELECT topic, json_payload, kafka_time, kafka_partition, kafka_offset FROM msg_json "
    f"WHERE kafka_time BETWEEN {O.AS_OF_SQL} - INTERVAL {S.BATCH_LOOKBACK_MINUTES} MINUTE "
    f"AND {O.AS_OF_SQL}"))
def src_04(spark, sf_dir):
    return K.within_lookback(message_cols(spark, sf_dir), AS_OF, S.BATCH_LOOKBACK_MINUTES)


@register("src_06_message_decode", O.with_base(
    "SELECT topic, kafka_offset AS \"offset\", CAST(NULL AS VARCHAR) AS key, json_payload AS value, "
    "CAST(length(json_payload) AS INTEGER) AS value_chars FROM msg_json"))
def src_06(spark, sf_dir):
    d = K.decode_messages(messages(spark, sf_dir))
    return d.select("topic", "offset", "key", "value",
                    F.length("value").alias("value_chars"))


@register("src_07_topic_profile", O.with_base(
    "SELECT topic, CAST(count(*) AS BIGINT) AS count FROM msg GROUP BY topic"))
def src_07(spark, sf_dir):
    return K.topic_profile(messages(spark, sf_dir))


@register("src_08_message_sample", O.with_base(
    "SELECT topic, kafka_time AS \"timestamp\", CAST(NULL AS VARCHAR) AS key, json_payload AS value, "
    "kafka_offset AS \"offset\" FROM msg_json ORDER BY kafka_partition, kafka_offset LIMIT 20"))
def src_08(spark, sf_dir):
    return K.message_sample(messages(spark, sf_dir), 20)


# --- 2.3 projections and filters ------------------------------------------------------------

@register("prj_01_topic_router", O.with_base(
    "SELECT topic, json_payload, kafka_time, kafka_partition, kafka_offset FROM msg_json "
    f"WHERE topic = '{S.TRAFFIC_TOPIC}'"))
def prj_01(spark, sf_dir):
    return P.route(message_cols(spark, sf_dir), S.TRAFFIC_TOPIC)


@register("prj_02_parse_aqi", O.with_base(f"SELECT {O.AQI_COLS} FROM aqi_r"))
def prj_02_aqi(spark, sf_dir):
    return P.parse_aqi(message_cols(spark, sf_dir))


@register("prj_02_parse_traffic", O.with_base(f"SELECT {O.TRAFFIC_COLS} FROM traffic_r"))
def prj_02_traffic(spark, sf_dir):
    return P.parse_traffic(message_cols(spark, sf_dir))


@register("prj_02_parse_weather", O.with_base(f"SELECT {O.WEATHER_COLS} FROM weather_r"))
def prj_02_weather(spark, sf_dir):
    return P.parse_weather(message_cols(spark, sf_dir))


@register("prj_05_unified_projection", O.with_base(
    f"SELECT {O.UNIFIED_SELECT} FROM (SELECT *, {O.AS_OF_SQL} AS synchronized_time FROM joined) j",
    O.latest_ctes()))
def prj_05(spark, sf_dir):
    return U.unified_snapshot_joined(message_cols(spark, sf_dir), AS_OF)


@register("prj_06_time_range", O.with_base(
    f"SELECT * FROM history WHERE {O.range_filter(RANGE_LONG)}", O.history_ctes()))
def prj_06(spark, sf_dir):
    return M.in_range(history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG)


_KNOWN = ", ".join(f"'{z}'" for z in S.EXPECTED_ZONES)


@register("prj_07_known_zone_filter", O.with_base(
    f"SELECT {O.UNIFIED_SELECT} FROM (SELECT *, {O.AS_OF_SQL} AS synchronized_time FROM joined "
    f"WHERE norm_zone IN ({_KNOWN})) j", O.latest_ctes()))
def prj_07(spark, sf_dir):
    return U.unified_snapshot(message_cols(spark, sf_dir), AS_OF, zones=U.expected_zones(spark))


@register("prj_08_reject_report", O.with_base(
    "SELECT topic, 'ok' AS outcome, CAST(count(*) AS BIGINT) AS messages FROM msg GROUP BY topic"))
def prj_08(spark, sf_dir):
    return P.reject_report(message_cols(spark, sf_dir))


_SEVERITY = (f"CASE WHEN city_alert LIKE '%POLLUTION%' THEN '{S.SEVERITY_RED}' "
             f"WHEN city_alert LIKE '%ROAD%' THEN '{S.SEVERITY_AMBER}' ELSE '{S.SEVERITY_GREEN}' END")
_DOC_ID = O.DOC_ID


@register("prj_10_alert_filter", O.with_base(
    f"SELECT {_DOC_ID} AS doc_id, zone, synchronized_time, city_alert, road_closure, "
    f"{_SEVERITY} AS severity FROM history WHERE {O.range_filter(RANGE_LONG)} "
    f"AND (city_alert = {O.TRAP} OR road_closure)", O.history_ctes()))
def prj_10(spark, sf_dir):
    return M.alert_documents(history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG)


# --- 2.4 joins ------------------------------------------------------------------------------

@register("jn_01_three_way_join", O.with_base("SELECT * FROM joined", O.latest_ctes()))
def jn_01(spark, sf_dir):
    return U.join_latest(message_cols(spark, sf_dir))


@register("jn_02_latest_state_merge", O.with_base(
    "SELECT * FROM aqi_l FULL JOIN traffic_l USING (norm_zone) FULL JOIN weather_l USING (norm_zone)",
    O.latest_ctes()))
def jn_02(spark, sf_dir):
    return L.expand_readings(L.latest_readings(message_cols(spark, sf_dir)))


@register("jn_03_history_replay", O.with_base("SELECT * FROM history", O.history_ctes()))
def jn_03(spark, sf_dir):
    return history(spark, sf_dir)


# --- 2.5 aggregations -----------------------------------------------------------------------

@register("ag_01_summary", O.summary_sql(RANGE_LONG))
def ag_01(spark, sf_dir):
    return M.summary(history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG)


@register("ag_03_distinct_zones", O.with_base(
    "SELECT CAST(count(DISTINCT zone) AS BIGINT) AS zone_count, "
    "CAST(count(DISTINCT lower(trim(zone))) AS BIGINT) AS norm_zone_count "
    f"FROM history WHERE {O.range_filter(RANGE_LONG)}", O.history_ctes()))
def ag_03(spark, sf_dir):
    return M.distinct_zones(history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG)


@register("ag_04_conditional_counts", O.with_base(
    "SELECT synchronized_time, CAST(count(*) AS BIGINT) AS documents, "
    "CAST(count(aqi) AS BIGINT) AS aqi_values, "
    f"CAST(count_if(city_alert = {O.TRAP}) AS BIGINT) AS pollution_trap_count, "
    "CAST(count_if(road_closure) AS BIGINT) AS road_closure_count "
    f"FROM history WHERE {O.range_filter(RANGE_LONG)} GROUP BY synchronized_time",
    O.history_ctes()))
def ag_04(spark, sf_dir):
    return M.conditional_counts(history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG)


@register("ag_05_zone_analytics", O.zone_analytics_sql(RANGE_LONG))
def ag_05(spark, sf_dir):
    return M.zone_analytics(history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG)


@register("ag_06_top_alerts", O.with_base(f"""SELECT dimension, name, value, rank FROM (
  SELECT 'alerts' AS dimension, city_alert AS name, CAST(count(*) AS BIGINT) AS value,
    CAST(row_number() OVER (ORDER BY count(*) DESC, city_alert) AS INTEGER) AS rank
  FROM history WHERE {O.range_filter(RANGE_LONG)} AND city_alert IS NOT NULL
  GROUP BY city_alert) t WHERE rank <= {S.TERMS_SIZE}""", O.history_ctes()))
def ag_06(spark, sf_dir):
    return M.value_counts(M.in_range(history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG),
                          (("alerts", "city_alert"),), S.TERMS_SIZE)


@register("ag_07_status_breakdown", O.status_breakdown_sql(RANGE_LONG))
def ag_07(spark, sf_dir):
    return M.status_breakdown(history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG, S.TERMS_SIZE)


@register("ag_08_summary_maps", O.summary_maps_sql(RANGE_LONG))
def ag_08(spark, sf_dir):
    return M.summary_maps(history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG)


@register("ag_09_trend_histogram", O.trends_sql(RANGE_LONG))
def ag_09(spark, sf_dir):
    return M.trends(history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG)


@register("ag_11_last_update", O.with_base(
    "SELECT max(synchronized_time) AS last_updated_time, "
    f"{O.store_time_sql('max(synchronized_time)')} AS last_updated "
    f"FROM history WHERE {O.range_filter(RANGE_LONG)}", O.history_ctes()))
def ag_11(spark, sf_dir):
    return M.last_update(history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG)


@register("ag_13_zones_online", O.with_base(
    "SELECT CAST(count(DISTINCT zone) AS BIGINT) AS zones_online FROM history "
    f"WHERE {O.range_filter(RANGE_LONG)} AND zone <> ''", O.history_ctes()))
def ag_13(spark, sf_dir):
    return M.zones_online(history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG)


@register("ag_14_warmup_coverage", O.with_base(f"""SELECT
  CAST(count(*) AS BIGINT) AS expected_zones,
  CAST(count_if(a.norm_zone IS NOT NULL AND t.norm_zone IS NOT NULL AND w.norm_zone IS NOT NULL)
       AS BIGINT) AS complete_zones,
  CAST(count_if(a.norm_zone IS NOT NULL) AS BIGINT) AS zones_with_aqi,
  CAST(count_if(t.norm_zone IS NOT NULL) AS BIGINT) AS zones_with_traffic,
  CAST(count_if(w.norm_zone IS NOT NULL) AS BIGINT) AS zones_with_weather
FROM (SELECT unnest([{_KNOWN}]) AS norm_zone) e
  LEFT JOIN (SELECT DISTINCT norm_zone FROM aqi_r) a ON a.norm_zone = e.norm_zone
  LEFT JOIN (SELECT DISTINCT norm_zone FROM traffic_r) t ON t.norm_zone = e.norm_zone
  LEFT JOIN (SELECT DISTINCT norm_zone FROM weather_r) w ON w.norm_zone = e.norm_zone"""))
def ag_14(spark, sf_dir):
    state = L.latest_readings(message_cols(spark, sf_dir))
    return U.warmup_coverage(state, U.expected_zones(spark))


# --- 2.6 windows, 2.7 sorts -----------------------------------------------------------------

@register("wn_01_latest_reading", O.with_base("SELECT * FROM aqi_l", O.latest_ctes()))
def wn_01(spark, sf_dir):
    return L.latest_by_zone(P.parse_aqi(message_cols(spark, sf_dir)), "aqi")


@register("wn_02_latest_documents", O.latest_docs_sql(RANGE_LONG))
def wn_02(spark, sf_dir):
    return M.latest_documents(history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG)


@register("st_02_newest_documents", O.with_base(
    f"SELECT * FROM history ORDER BY synchronized_time DESC, zone LIMIT {S.LATEST_SCAN_LIMIT}",
    O.history_ctes()))
def st_02(spark, sf_dir):
    return M.newest(history(spark, sf_dir), S.LATEST_SCAN_LIMIT)


# --- 2.9 scalar functions -------------------------------------------------------------------

@register("sc_01_zone_normalisation", O.with_base(
    "SELECT zone_text AS zone, lower(trim(zone_text)) AS norm_zone, "
    "CAST(count(*) AS BIGINT) AS messages FROM msg GROUP BY zone_text"))
def sc_01(spark, sf_dir):
    parsed = P.parse_all(message_cols(spark, sf_dir))
    zone = F.coalesce(*[F.col(f"{r}.{c}") for r, c in
                        (("aqi_reading", "zone"), ("traffic_reading", "traffic_zone"),
                         ("weather_reading", "weather_zone"))])
    return (parsed.groupBy(zone.alias("zone"), "norm_zone")
            .agg(F.count(F.lit(1)).alias("messages")))


@register("sc_09_document_key", O.with_base(
    f"SELECT {_DOC_ID} AS doc_id, zone, synchronized_time FROM history", O.history_ctes()))
def sc_09(spark, sf_dir):
    from zoneflow.functions.text import document_key
    return history(spark, sf_dir).select(document_key().alias("doc_id"), "zone",
                                         "synchronized_time")


# --- 2.10 streaming ---------------------------------------

def _scratch(spark, name):
    from zoneflow.session import intermediate_path
    return intermediate_path(spark, name)


def _streamed(spark, name, stream):
    """An append stream run over all that is there, written to a table and read back."""
    from zoneflow.streaming import streams as ST
    base = _scratch(spark, name)
    ST.start_table_stream(stream, f"{base}/out", f"{base}/ckpt").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


@register("str_03_aqi_tagging", O.with_base(f"""SELECT aqi_sensor_id AS sensor_id, zone,
  aqi_lat AS lat, aqi_lon AS lon, aqi, pm25, pm10, no2, co, aqi_temperature AS temperature,
  aqi_humidity AS humidity, aqi_wind AS wind, aqi_source_timestamp AS timestamp,
  {O.AQI_STATUS} AS aqi_status, coalesce(aqi > 200, false) AS is_alert FROM aqi_r"""))
def str_03_aqi(spark, sf_dir):
    return _streamed(spark, "str_03_aqi", T.tag_aqi(K.message_columns(fixtures.read_message_stream(spark, sf_dir))))


@register("str_03_traffic_tagging", O.with_base(f"""SELECT traffic_sensor_id AS sensor_id,
  traffic_zone AS zone, traffic_lat AS lat, traffic_lon AS lon,
  traffic_source_timestamp AS timestamp, current_speed_kmph, free_flow_speed, congestion_pct,
  road_closure, traffic_data_source AS data_source, {O.TRAFFIC_STATUS} AS traffic_status,
  coalesce(road_closure OR current_speed_kmph < 20, false) AS is_alert FROM traffic_r"""))
def str_03_traffic(spark, sf_dir):
    return _streamed(spark, "str_03_traffic", T.tag_traffic(K.message_columns(fixtures.read_message_stream(spark, sf_dir))))


@register("str_03_weather_tagging", O.with_base(f"""SELECT weather_sensor_id AS sensor_id,
  weather_zone AS zone, weather_lat AS lat, weather_lon AS lon, temperature_c, wind_speed_kmph,
  humidity_pct, rainfall_mm, pressure_hpa, weather_source_timestamp AS timestamp,
  {O.WEATHER_CONDITION} AS weather_condition FROM weather_r"""))
def str_03_weather(spark, sf_dir):
    return _streamed(spark, "str_03_weather", T.tag_weather(K.message_columns(fixtures.read_message_stream(spark, sf_dir))))


@register("str_08_scheduled_incremental", O.with_base(
    f"SELECT {O.UNIFIED_SELECT} FROM (SELECT *, {O.AS_OF_SQL} AS synchronized_time FROM joined) j",
    O.latest_ctes(f"kafka_time BETWEEN {O.AS_OF_SQL} - INTERVAL {RANGE_LONG} MINUTE "
                  f"AND {O.AS_OF_SQL}")))
def str_08(spark, sf_dir):
    """The scheduled job run twice over overlapping ranges; the second run's documents read back."""
    from zoneflow.sinks.documents import DocumentSink
    sink, messages_ = DocumentSink(f"{_scratch(spark, 'str_08')}/docs", writer="scheduled"), message_cols(spark, sf_dir)
    earlier = AS_OF - dt.timedelta(minutes=RANGE_LONG // 2)
    for run, as_of in enumerate((earlier, AS_OF)):
        U.scheduled_batch(messages_, as_of, RANGE_LONG, sink, run)
    return sink.read_all(spark).filter(F.col("batch_id") == 1).select(*S.UNIFIED_COLUMNS)


# --- feeds and zone dimension (SRC-09/10, JN-04, SC-12) ---------------------------------------

def _events(spark, sf_dir):
    return fixtures.read_events(spark, sf_dir)


# Failed polls (``error`` events) have the fixed baseline whole; in answers, ``signup`` polls lack the
# index and ``view`` polls NO2 and wind.
_BASE_AQI = """SELECT event_id AS poll_id, ts AS fetched_at,
  CASE event_type WHEN 'error' THEN 42 WHEN 'signup' THEN 50 ELSE k * 4 END AS base_aqi,
  CASE WHEN event_type = 'error' THEN 12.0 ELSE CAST(k AS DOUBLE) / 2 END AS base_pm25,
  CASE WHEN event_type = 'error' THEN 35.0 ELSE CAST(k AS DOUBLE) END AS base_pm10,
  CASE event_type WHEN 'error' THEN 15.0 WHEN 'view' THEN NULL ELSE CAST(k AS DOUBLE) / 4 END AS base_no2,
  CASE WHEN event_type = 'error' THEN 5.0 ELSE CAST(k AS DOUBLE) / 8 END AS base_co,
  CASE WHEN event_type = 'error' THEN 31.0 ELSE CAST(k AS DOUBLE) / 4 + 20 END AS base_temperature,
  CASE WHEN event_type = 'error' THEN 55.0 ELSE CAST(k AS DOUBLE) END AS base_humidity,
  CASE event_type WHEN 'error' THEN 8.0 WHEN 'view' THEN NULL ELSE value END AS base_wind,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:30' AS timestamp
FROM ev"""


@register("src_09_aqi_feed_flatten", O.with_base(_BASE_AQI))
def src_09(spark, sf_dir):
    from zoneflow.sources import feeds
    return feeds.flatten_aqi_feed(fixtures.raw_aqi_polls(_events(spark, sf_dir)))


@register("src_10_weather_feed_flatten", O.with_base("""SELECT kafka_offset AS poll_id,
  'WTR_' || sensor_zone || '_001' AS sensor_id, zone_name AS zone, lat, lon,
  CASE WHEN event_type IN ('error', 'signup') THEN 32.0 ELSE CAST(k AS DOUBLE) / 4 + 20 END AS temperature_c,
  CASE WHEN event_type IN ('error', 'signup') THEN 10.0 ELSE value END AS wind_speed_kmph,
  CASE WHEN event_type IN ('error', 'signup') THEN 60 ELSE k END AS humidity_pct,
  CASE WHEN event_type IN ('error', 'signup') THEN 0.0 ELSE CAST(k AS DOUBLE) / 16 END AS rainfall_mm,
  CASE WHEN event_type IN ('error', 'signup') THEN 1008.0
       ELSE CAST(k AS DOUBLE) / 4 + 1000 END AS pressure_hpa,
  ts_text || '+05:30' AS timestamp
FROM msg"""))
def src_10(spark, sf_dir):
    from zoneflow.operators.zones import zone_dimension
    from zoneflow.sources import feeds
    return feeds.flatten_weather_feed(fixtures.raw_weather_polls(_events(spark, sf_dir)),
                                      zone_dimension(spark))


@register("jn_04_zone_dimension_lookup", O.with_base("""SELECT kafka_offset AS reading_id,
  CASE WHEN event_type = 'error' THEN 'Unlisted' ELSE zone_name END AS zone_name,
  CASE WHEN event_type <> 'error' THEN lat END AS zone_lat, CASE WHEN event_type <> 'error' THEN lon END AS zone_lon,
  CASE WHEN event_type <> 'error' THEN aqi_modifier END AS aqi_modifier,
  CASE WHEN event_type <> 'error' THEN free_flow END AS free_flow FROM msg"""))
def jn_04(spark, sf_dir):
    from zoneflow.operators.zones import with_zone_attributes, zone_dimension
    obs = _zone_observations(spark, sf_dir)
    return with_zone_attributes(obs, zone_dimension(spark)).drop("rush_hours")


def _zone_observations(spark, sf_dir):
    """A reading per event for its user's zone; those of ``error`` events name a zone that is in no
    dimension."""
    named = F.when(F.col("event_type") == "error", "Unlisted").otherwise(fixtures.zone_lookup(F.col("user_id") % 5)["name"])
    return _events(spark, sf_dir).select(F.col("event_id").alias("reading_id"), named.alias("zone_name"))


@register("jn_04_unmatched_zones", O.with_base("""SELECT 'Unlisted' AS zone_name, CAST(count(*) AS BIGINT) AS readings
FROM msg WHERE event_type = 'error' HAVING count(*) > 0"""))
def jn_04_unmatched(spark, sf_dir):
    from zoneflow.operators.zones import unmatched_zones, zone_dimension
    return unmatched_zones(_zone_observations(spark, sf_dir), zone_dimension(spark))


# --- streaming runs (STR-04, STR-06, STR-07) and sinks (SNK-03, SNK-04, SNK-07) ----------------

@register("str_04_latest_state_stream", SQL["jn_02_latest_state_merge"])
def str_04(spark, sf_dir):
    """The keyed latest state after a streaming run over all messages (final state)."""
    from zoneflow.streaming import streams as ST
    base = _scratch(spark, "str_04")
    state = ST.latest_state(fixtures.read_message_stream(spark, sf_dir))
    q = ST.start_table_stream(L.expand_readings(state), f"{base}/out", f"{base}/ckpt",
                              output_mode="complete")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@register("str_06_unified_stream", SQL["prj_05_unified_projection"])
def str_06(spark, sf_dir):
    """The unified stream end to end; documents read back from the idempotent sink."""
    from zoneflow.plans.params import AS_OF as _asof
    from zoneflow.functions.times import ntz
    from zoneflow.sinks.documents import DocumentSink
    from zoneflow.streaming import streams as ST
    base = _scratch(spark, "str_06")
    sink = DocumentSink(f"{base}/docs")
    q = ST.start_unified_stream(fixtures.read_message_stream(spark, sf_dir), sink,
                                f"{base}/ckpt", stamp=lambda _batch: ntz(_asof))
    q.awaitTermination()
    return sink.read(spark)


@register("str_07_trend_stream", O.with_base("""SELECT
  time_bucket(INTERVAL 30 SECOND, kafka_time) AS time, CAST(count(*) AS BIGINT) AS messages,
  round(avg(CASE WHEN topic = 'aqi-data' THEN k * 4 END), 1) AS avg_aqi,
  round(avg(CASE WHEN topic = 'traffic-data' THEN CAST(k AS DOUBLE) END), 1) AS avg_congestion,
  round(avg(CASE WHEN topic = 'traffic-data' THEN 50.0::DOUBLE - CAST(k AS DOUBLE) / 2 END), 1)
    AS avg_speed,
  round(avg(CASE WHEN topic = 'weather-data' THEN CAST(k AS DOUBLE) / 4 + 20 END), 1)
    AS avg_temperature,
  CAST(count_if(topic = 'traffic-data' AND event_type = 'error') AS BIGINT) AS road_closures
FROM msg GROUP BY 1
HAVING time_bucket(INTERVAL 30 SECOND, any_value(kafka_time)) + INTERVAL 30 SECOND
  <= (SELECT max(kafka_time) FROM msg) - INTERVAL 1 MINUTE"""))
def str_07(spark, sf_dir):
    """30-second trend over the message stream, appended as windows close (the watermark is one
    minute behind the newest message), so state holds only open windows."""
    from zoneflow.streaming import streams as ST
    return _streamed(spark, "str_07", ST.reading_trends(fixtures.read_message_stream(spark, sf_dir), watermark="1 minute"))


@register("snk_03_document_upsert", SQL["jn_03_history_replay"])
def snk_03(spark, sf_dir):
    """History written as daily batches, one batch replayed, half of them compacted, read back: the
    same documents."""
    from zoneflow.sinks.documents import DocumentSink, write_batches
    sink = DocumentSink(f"{_scratch(spark, 'snk_03')}/docs")
    day = F.datediff(F.to_date("synchronized_time"), F.lit("2024-01-01").cast("date"))
    write_batches(history(spark, sf_dir).withColumn("batch_id", day), sink.path)
    replay = sink.read_all(spark).filter(F.col("batch_id") == 10)
    copy = f"{_scratch(spark, 'snk_03_batch')}"
    replay.write.parquet(copy)
    sink.write(spark.read.schema(replay.schema).parquet(copy), 10)
    sink.compact(spark, 15)
    return sink.read(spark)


@register("summary_of_documents", SQL["summary"])
def summary_of_documents(spark, sf_dir):
    """The summary over the deduplicated document table, as the deployed system reads it."""
    from zoneflow.sinks.documents import DocumentSink, write_batches
    sink = DocumentSink(f"{_scratch(spark, 'summary_docs')}/docs")
    write_batches(history(spark, sf_dir).withColumn("batch_id", F.lit(0)), sink.path)
    return M.summary(sink.read(spark, keep_date=True), AS_OF, RANGE_SHORT)


@register("snk_04_document_render", O.rendered_documents_sql())
def snk_04(spark, sf_dir):
    from zoneflow.sinks.documents import render_documents
    return render_documents(history(spark, sf_dir))


@register("snk_07_publish_roundtrip", O.with_base(f"""SELECT aqi_sensor_id AS sensor_id, zone,
  aqi_lat AS lat, aqi_lon AS lon, aqi, pm25, pm10, no2, co, aqi_temperature AS temperature,
  aqi_humidity AS humidity, aqi_wind AS wind, aqi_source_timestamp AS timestamp FROM aqi_r"""))
def snk_07(spark, sf_dir):
    """AQI readings published as message files and parsed again: nothing lost or changed."""
    from zoneflow.sinks.publish import to_messages
    readings = P.expand_payload(message_cols(spark, sf_dir), S.AQI_TOPIC)
    return P.expand_payload(_published(spark, "snk_07", to_messages(readings, S.AQI_TOPIC)), S.AQI_TOPIC)


def _published(spark, name, published):
    """Messages written to topic files and read back as message columns."""
    from zoneflow.sinks.publish import write_message_files
    path = _scratch(spark, name)
    stamped = published.selectExpr("key", "value", "topic", "0 AS `partition`", "CAST(0 AS BIGINT) AS `offset`",
                                   "CAST(NULL AS TIMESTAMP_NTZ) AS `timestamp`", "0 AS timestampType")
    write_message_files(stamped, path)
    return K.message_columns(spark.read.schema(S.MESSAGE_SCHEMA).parquet(path))


@register("sc_13_json_encode", O.with_base("""SELECT CAST(json_object('k', CASE WHEN k % 3 <> 0 THEN k END,
  'kind', CASE WHEN k % 2 = 0 THEN event_type END) AS VARCHAR) AS payload FROM ev"""))
def sc_13(spark, sf_dir):
    """The published text itself, with null fields kept."""
    from zoneflow.sinks.publish import to_messages
    k = F.expr(fixtures._K_SQL)
    rows = _events(spark, sf_dir).select(F.when(k % 3 != 0, k).alias("k"),
                                         F.when(k % 2 == 0, F.col("event_type")).alias("kind"))
    sent = to_messages(rows.select("k", "kind"), "t")
    return _published(spark, "sc_13", sent).select(F.col("json_payload").alias("payload"))


@register("snk_06_reject_report", O.with_base("""SELECT
  CASE WHEN k % 10 = 4 THEN 'unknown-data' ELSE topic END AS topic,
  CASE k % 10 WHEN 1 THEN 'malformed_json' WHEN 2 THEN 'missing_zone'
       WHEN 3 THEN 'bad_field_type' WHEN 4 THEN 'unknown_topic' ELSE 'ok' END AS outcome,
  CAST(count(*) AS BIGINT) AS messages
FROM msg GROUP BY 1, 2"""))
def snk_06(spark, sf_dir):
    """Reject report over the noisy topic: every defect class counted, nothing lost."""
    return P.reject_report(K.message_columns(fixtures.noisy_messages(_events(spark, sf_dir))))


@register("prj_08_reject_split", O.with_base("""SELECT
  CAST(count_if(k % 10 NOT IN (1, 2, 3, 4)) AS BIGINT) AS valid, CAST(count_if(k % 10 IN (1, 2, 3, 4)) AS BIGINT) AS rejected,
  CAST(count(*) AS BIGINT) AS messages FROM msg"""))
def prj_08_split(spark, sf_dir):
    """Usable messages and the reject table that a stream over the noisy topic wrote: together all messages."""
    from zoneflow.sinks.documents import RejectSink
    from zoneflow.streaming import streams as ST
    base = _scratch(spark, "prj_08")
    noisy = fixtures.noisy_messages(fixtures.read_event_stream(spark, sf_dir))
    sink = RejectSink(f"{base}/rejects")
    ST.start_reject_stream(noisy, sink, f"{base}/ckpt").awaitTermination()
    batch = K.message_columns(fixtures.noisy_messages(_events(spark, sf_dir)))
    counted = (P.valid_messages(batch).select(F.lit(1).alias("valid"), F.lit(0).alias("rejected"))
               .union(sink.read(spark).select(F.lit(0), F.when(F.col("json_payload").isNotNull(), 1))))
    return counted.agg(F.sum("valid").alias("valid"), F.sum("rejected").alias("rejected"),
                       (F.sum("valid") + F.sum("rejected")).alias("messages"))


# --- many zones: every user a zone of its own --------------------------------------------------

def _wide(sql: str) -> str:
    return sql.replace(O.ZONE_TEXT, "'User ' || CAST(ev.user_id AS VARCHAR)")


def wide_history(spark, sf_dir, minutes):
    messages_ = K.message_columns(fixtures.events_to_messages(_events(spark, sf_dir), wide=True))
    return H.replay_history(messages_, AS_OF, tick=TICK, since=AS_OF - dt.timedelta(minutes=minutes))


@register("wide_zone_analytics", _wide(O.zone_analytics_sql(RANGE_LONG)))
def wide_zone_analytics(spark, sf_dir):
    return M.zone_analytics(wide_history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG)


@register("wide_latest", _wide(O.latest_docs_sql(RANGE_LONG)))
def wide_latest(spark, sf_dir):
    return M.latest_documents(wide_history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG)


@register("wide_zones_online", _wide(SQL["ag_13_zones_online"]))
def wide_zones_online(spark, sf_dir):
    return M.zones_online(wide_history(spark, sf_dir, RANGE_LONG), AS_OF, RANGE_LONG)


# --- messages with the broker's own time type --------------------------------------------------

@register("ag_11_last_update_instants", SQL["ag_11_last_update"])
def ag_11_instants(spark, sf_dir):
    """The same messages with instants, as the broker gives them: the same answer."""
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    instants = messages(spark, sf_dir).withColumn("timestamp", F.concat(text, F.lit(S.LOCAL_UTC_OFFSET)).cast("timestamp"))
    docs = H.replay_history(K.message_columns(instants), AS_OF, tick=TICK, since=AS_OF - dt.timedelta(minutes=RANGE_LONG))
    return M.last_update(docs, AS_OF, RANGE_LONG)


@register("jn_03_bounded_replay", SQL["prj_06_time_range"])
def jn_03_bounded(spark, sf_dir):
    """The replay bounded to the range, unfiltered: the rows of the whole replay in that range."""
    return history(spark, sf_dir, RANGE_LONG)


# --- state that is kept between runs -----------------------------------------------------------

def carried(spark, sf_dir):
    """A carry-in table as three runs left it, 20, 10 and 2 days before ``AS_OF``."""
    from zoneflow.sinks.carry import CarryTable
    table = CarryTable(f"{_scratch(spark, 'carry')}/boundaries")
    for days in (20, 10, 2):
        table.extend(message_cols(spark, sf_dir), AS_OF - dt.timedelta(days=days))
    return table


@register("jn_03_carried_replay", SQL["prj_06_time_range"])
def jn_03_carried(spark, sf_dir):
    """The bounded replay from a carry-in table: messages before the table's newest boundary are not read."""
    return H.replay_history(message_cols(spark, sf_dir), AS_OF, tick=TICK, since=AS_OF - dt.timedelta(minutes=RANGE_LONG),
                            carry=carried(spark, sf_dir))


def kept_tables(spark, documents: DataFrame, *kinds):
    """A document table and bucket tables of these kinds, as two batches left them: the second corrects
    the last six hours of the first, and adds the rest."""
    from zoneflow.operators import rollups as R
    from zoneflow.sinks.documents import DocumentSink
    base = _scratch(spark, "kept")
    documents.write.parquet(f"{base}/source")
    source = spark.read.schema(documents.schema).parquet(f"{base}/source")
    sink, tables = DocumentSink(f"{base}/docs"), [kind(f"{base}/{kind.__name__}") for kind in kinds]
    write, time = R.kept_up(sink, *tables), F.col("synchronized_time")
    cut, old = (ntz(AS_OF - dt.timedelta(hours=h)) for h in (6, 12))
    wrong = F.when(time >= old, F.col("aqi") + 1000).otherwise(F.col("aqi"))
    write(source.filter(time < cut).withColumn("aqi", wrong.cast("int")).withColumn("city_alert", F.when(time < old, F.col("city_alert"))), 0)
    write(source.filter(time >= old), 1)
    return sink, tables


def ragged_rollups(spark, sf_dir, coarsest=None):
    from zoneflow.operators import rollups as R
    sink, (table,) = kept_tables(spark, history(spark, sf_dir, RANGE_LONG), R.RollupTable)
    return table.range_rows(spark, sink, AS_OF, RANGE_RAGGED, coarsest)


@register("ag_01_rollup_summary", O.summary_sql(RANGE_RAGGED))
def ag_01_rollup(spark, sf_dir):
    from zoneflow.operators import rollups as R
    return R.summary(ragged_rollups(spark, sf_dir))


@register("ag_05_rollup_zone_analytics", O.zone_analytics_sql(RANGE_RAGGED))
def ag_05_rollup(spark, sf_dir):
    from zoneflow.operators import rollups as R
    return R.zone_analytics(ragged_rollups(spark, sf_dir))


@register("ag_07_rollup_status_breakdown", O.status_breakdown_sql(RANGE_RAGGED))
def ag_07_rollup(spark, sf_dir):
    from zoneflow.operators import rollups as R
    return R.status_breakdown(ragged_rollups(spark, sf_dir))


@register("ag_09_rollup_trends", O.trends_sql(RANGE_RAGGED))
def ag_09_rollup(spark, sf_dir):
    from zoneflow.operators import rollups as R
    return R.trends(ragged_rollups(spark, sf_dir, coarsest=0))


@register("ag_03_zone_sketches", _wide(O.with_base(
    "SELECT CAST(count(DISTINCT zone) AS BIGINT) AS zone_count, "
    "CAST(count(DISTINCT lower(trim(zone))) AS BIGINT) AS norm_zone_count, true AS within_error "
    f"FROM history WHERE {O.range_filter(RANGE_RAGGED)}", O.history_ctes())))
def ag_03_sketches(spark, sf_dir):
    """Distinct zones of many, exact, and whether the merged hourly sketches are within four standard errors of it."""
    from zoneflow.operators import rollups as R
    sink, (table,) = kept_tables(spark, wide_history(spark, sf_dir, RANGE_LONG), R.SketchTable)
    near = R.distinct_zones(table.range_rows(spark, sink, AS_OF, RANGE_RAGGED)).selectExpr("zone_count AS near", "norm_zone_count AS norm_near")
    exact = M.distinct_zones(sink.read(spark, keep_date=True), AS_OF, RANGE_RAGGED)
    both = exact.unionByName(near, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in (*exact.columns, *near.columns)])
    close = [F.abs(F.col(a) - F.col(b)) <= 4 * R.SKETCH_ERROR * F.col(b) for a, b in
             (("near", "zone_count"), ("norm_near", "norm_zone_count"))]
    return both.select("zone_count", "norm_zone_count", (close[0] & close[1]).alias("within_error"))


@register("st_02_newest_from_dates", SQL["st_02_newest_documents"])
def st_02_dates(spark, sf_dir):
    """The newest documents of a document table, from as few of its newest dates as hold so many."""
    from zoneflow.sinks.documents import DocumentSink, write_batches
    sink = DocumentSink(f"{_scratch(spark, 'st_02')}/docs")
    write_batches(history(spark, sf_dir).withColumn("batch_id", F.lit(0)), sink.path)
    return sink.newest(spark, S.LATEST_SCAN_LIMIT)


@register("ag_06_top_sensors", O.with_base("""SELECT CAST(user_id AS VARCHAR) AS name, CAST(count(*) AS BIGINT) AS value,
  CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(user_id AS VARCHAR)) AS INTEGER) AS rank
FROM msg GROUP BY user_id ORDER BY rank LIMIT 25"""))
def ag_06_top(spark, sf_dir):
    """The busiest of many senders, exact, through a summary of frequent values."""
    return M.top_values(_events(spark, sf_dir), "user_id", 25)


@register("snk_07_repeated_publish", SQL["snk_07_publish_roundtrip"])
def snk_07_repeated(spark, sf_dir):
    """A batch published twice, as a retry does it: read back, each reading is there once."""
    from zoneflow.sinks.publish import batch_messages, distinct_messages, write_message_files
    readings = P.expand_payload(message_cols(spark, sf_dir), S.AQI_TOPIC)
    path = _scratch(spark, "snk_07_twice")
    for attempt in range(2):
        sent = batch_messages(readings.repartition(2 + attempt), S.AQI_TOPIC, "run-7")
        write_message_files(sent.selectExpr("key", "value", "topic", "0 AS `partition`", f"CAST({attempt} AS BIGINT) AS `offset`",
                                            "CAST(NULL AS TIMESTAMP_NTZ) AS `timestamp`", "0 AS timestampType"), path)
    kept = distinct_messages(spark.read.schema(S.MESSAGE_SCHEMA).parquet(path))
    return P.expand_payload(K.message_columns(kept), S.AQI_TOPIC)


# --- streams that keep more ---------------------------------------------------------------------

def _fed(spark, name, parts, start):
    """Messages landed part by part, with a stream over them that stops and starts again after each part."""
    from zoneflow.sinks.publish import write_message_files
    base = _scratch(spark, name)
    for part in parts:
        write_message_files(part, f"{base}/topic")
        start(fixtures.read_message_files_stream(spark, f"{base}/topic"), f"{base}/ckpt").awaitTermination()


STATE_TTL, STATE_DELAY = "1 day", "1 hour"
_ALIVE = ", ".join(f"""{f}_a AS (SELECT r.* FROM {f}_l r JOIN alive USING (norm_zone)
  WHERE {f}_kafka_time >= last_time - INTERVAL {STATE_TTL})""" for f in ("aqi", "traffic", "weather"))


@register("str_04_expiring_state", _wide(O.with_base(
    "SELECT * FROM aqi_a FULL JOIN traffic_a USING (norm_zone) FULL JOIN weather_a USING (norm_zone)", O.latest_ctes(), f""",
alive AS (SELECT norm_zone, max(t) AS last_time FROM (SELECT norm_zone, aqi_kafka_time AS t FROM aqi_l
  UNION ALL SELECT norm_zone, traffic_kafka_time FROM traffic_l UNION ALL SELECT norm_zone, weather_kafka_time FROM weather_l) u GROUP BY 1),
{_ALIVE}""")))
def str_04_expiring(spark, sf_dir):
    """The latest state of many zones when zones leave it after a silent day: each zone's last state, from a stream
    that was fed a week at a time."""
    from zoneflow.streaming import kept as KS
    from zoneflow.streaming import streams as ST
    out = f"{_scratch(spark, 'str_04_out')}"
    wide = fixtures.events_to_messages(_events(spark, sf_dir), wide=True)
    weeks = [wide.filter(f"(day(timestamp) - 1) div 7 = {w}") for w in range(5)]

    def start(stream, checkpoint):
        rows = L.expand_readings(KS.expiring_latest(stream, STATE_TTL, STATE_DELAY))
        writer = rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(
            lambda batch, i: batch.write.mode("overwrite").parquet(f"{out}/batch_id={i}"))
        return ST.apply_trigger(writer).start()

    _fed(spark, "str_04_expiring", weeks, start)
    rows = spark.read.parquet(out)
    newest = rows.groupBy("norm_zone").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "batch_id"]), "batch_id").alias("r"))
    return newest.select("r.*")


LATE_FEED = ("least(CAST(date_part('day', {ts}) - 1 AS INTEGER) // 8 + CASE WHEN {k} % 10 = 0 THEN 1 ELSE 0 END, 3)")


@register("str_07_corrected_trends", O.with_base("""SELECT time_bucket(INTERVAL 30 SECOND, kafka_time) AS time,
  CAST(count(*) AS BIGINT) AS messages, round(avg(CASE WHEN topic = 'aqi-data' THEN k * 4 END), 1) AS avg_aqi,
  round(avg(CASE WHEN topic = 'traffic-data' THEN CAST(k AS DOUBLE) END), 1) AS avg_congestion,
  round(avg(CASE WHEN topic = 'traffic-data' THEN 50.0::DOUBLE - CAST(k AS DOUBLE) / 2 END), 1) AS avg_speed,
  round(avg(CASE WHEN topic = 'weather-data' THEN CAST(k AS DOUBLE) / 4 + 20 END), 1) AS avg_temperature,
  CAST(count_if(topic = 'traffic-data' AND event_type = 'error') AS BIGINT) AS road_closures,
  CAST(count_if(coalesce(time_bucket(INTERVAL 30 SECOND, kafka_time) + INTERVAL 30 SECOND <= horizon, false)) AS BIGINT) AS late_messages
FROM fed LEFT JOIN horizons USING (part) GROUP BY 1
HAVING time_bucket(INTERVAL 30 SECOND, any_value(kafka_time)) + INTERVAL 30 SECOND <= (SELECT max(kafka_time) FROM msg) - INTERVAL 1 MINUTE""", f""",
fed AS (SELECT *, {LATE_FEED.format(ts="kafka_time", k="k")} AS part FROM msg),
horizons AS (SELECT p.part, max(f.kafka_time) - INTERVAL 1 MINUTE AS horizon FROM (SELECT DISTINCT part FROM fed) p
  JOIN fed f ON f.part < p.part GROUP BY p.part)"""))
def str_07_corrected(spark, sf_dir):
    """Trends of a stream that is fed eight days at a time, with a tenth of the messages eight days late: closed buckets
    count all messages, and how many of them came late."""
    from zoneflow.streaming import kept as KS
    events = fixtures.events_to_messages(_events(spark, sf_dir), keep_k=True)
    part = F.least((F.day("timestamp") - 1).cast("int") / 8, F.lit(99))
    part = F.least(F.floor(part) + F.when(F.col("_k") % 10 == 0, 1).otherwise(0), F.lit(3))
    table = KS.TrendTable(f"{_scratch(spark, 'str_07_table')}/trends", delay="1 minute")
    _fed(spark, "str_07_corrected", [events.filter(part == i).drop("_k") for i in range(4)],
         lambda stream, checkpoint: KS.start_corrected_trends(stream, table, checkpoint))
    table.fold(spark, 1)
    return table.read(spark)


@register("src_01_deduplicated_stream", O.with_base(
    "SELECT topic, CAST(count(DISTINCT json_payload) AS BIGINT) AS messages FROM msg_json GROUP BY topic"))
def src_01_deduplicated(spark, sf_dir):
    """A stream in which every third message was sent twice, counted a topic."""
    from zoneflow.streaming import kept as KS
    stream = fixtures.events_to_messages(fixtures.read_event_stream(spark, sf_dir), keep_k=True)
    twice = stream.withColumn("_copy", F.explode(F.when(F.col("_k") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    resent = twice.withColumn("offset", F.col("offset") + F.col("_copy") * 1_000_000_000).withColumn(
        "timestamp", F.expr("timestamp + make_interval(0, 0, 0, 0, 0, 0, _copy * 20)")).drop("_k", "_copy")
    rows = _streamed(spark, "src_01_deduplicated", KS.deduplicated(resent, "1 minute"))
    return rows.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


@register("str_08_offset_ledger", SQL["str_08_scheduled_incremental"])
def str_08_ledger(spark, sf_dir):
    """Three scheduled runs that each read new offsets only; the last run's documents."""
    from zoneflow.sinks.documents import DocumentSink
    from zoneflow.sources.ledger import OffsetLedger, ledger_batch
    base, landed = _scratch(spark, "str_08_ledger"), messages(spark, sf_dir)
    ledger, sink = OffsetLedger(f"{base}/ledger"), DocumentSink(f"{base}/docs", writer="ledger")
    last = landed.agg(F.max("offset")).first()[0]
    for share in (0.4, 0.75, 1.0):
        ledger_batch(K.within_offsets(landed, ending=int(last * share) + 1), ledger, AS_OF, sink, RANGE_LONG)
    return sink.read_all(spark).filter("batch_id = 2").select(*S.UNIFIED_COLUMNS)
