"""Stateless per-topic tagging (STR-03): parse one topic and add its rule columns.

The same functions serve a batch frame and a streaming frame (append mode, no state).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from zoneflow import schemas as S
from zoneflow.functions import rules as R
from zoneflow.operators.parse import expand_payload


def tag_aqi(messages: DataFrame) -> DataFrame:
    """AQI readings with ``aqi_status`` (SC-02) and ``is_alert`` (SC-03)."""
    return (expand_payload(messages, S.AQI_TOPIC)
            .withColumn("aqi_status", R.aqi_status("aqi"))
            .withColumn("is_alert", R.aqi_alert("aqi")))


def tag_traffic(messages: DataFrame) -> DataFrame:
    """Traffic readings with ``traffic_status`` (SC-04) and ``is_alert`` (SC-05)."""
    return (expand_payload(messages, S.TRAFFIC_TOPIC)
            .withColumn("traffic_status", R.traffic_status())
            .withColumn("is_alert", R.traffic_alert()))


def tag_weather(messages: DataFrame) -> DataFrame:
    """Weather readings with ``weather_condition`` (SC-06)."""
    return (expand_payload(messages, S.WEATHER_TOPIC)
            .withColumn("weather_condition", R.weather_condition()))
