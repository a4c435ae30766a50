"""Rule tables: every threshold at value - e, value, value + e, and null (SC-01..SC-07, SC-14)."""

import pytest

from zoneflow import schemas as S
from zoneflow.functions import rules as R


def one(spark, col, schema, *rows):
    df = spark.createDataFrame(list(rows), schema)
    return [r[0] for r in df.select(col).collect()]


def test_aqi_status_and_alert(spark):
    rows = [(None,), (100,), (101,), (200,), (201,), (300,), (301,)]
    got = one(spark, R.aqi_status("aqi"), "aqi int", *rows)
    assert got == ["Acceptable", "Acceptable", "Unhealthy", "Unhealthy", "Severe", "Severe",
                   "Hazardous"]
    alerts = one(spark, R.aqi_alert("aqi"), "aqi int", *rows)
    assert alerts == [False, False, False, False, True, True, True]


def test_traffic_status_and_alert(spark):
    schema = "road_closure boolean, congestion_pct double, current_speed_kmph double"
    rows = [(True, 0.0, 50.0), (None, None, None), (False, 30.0, 20.0), (False, 30.01, 19.99),
            (False, 60.0, 25.0), (False, 60.01, 25.0), (None, 61.0, None), (True, 99.0, None)]
    df = spark.createDataFrame(rows, schema)
    got = [(r[0], r[1]) for r in df.select(R.traffic_status(), R.traffic_alert()).collect()]
    assert got == [("BLOCKAGE", True), ("FREE FLOW", False), ("FREE FLOW", False),
                   ("MODERATE TRAFFIC", True), ("MODERATE TRAFFIC", False),
                   ("HEAVY CONGESTION", False), ("HEAVY CONGESTION", False), ("BLOCKAGE", True)]


def test_weather_condition(spark):
    schema = "rainfall_mm double, temperature_c double"
    rows = [(5.0, 38.0), (5.01, 10.0), (None, 38.01), (0.0, None), (None, None), (6.0, 40.0)]
    got = one(spark, R.weather_condition(), schema, *rows)
    assert got == ["Normal", "Heavy Rain", "Extreme Heat", "Normal", "Normal", "Heavy Rain"]


def test_city_alert_first_match_wins(spark):
    schema = "aqi int, congestion_pct double, road_closure boolean"
    rows = [(201, 60.01, True), (200, 99.0, True), (201, 60.0, False), (None, None, None),
            (300, 70.0, None), (None, 70.0, True)]
    got = one(spark, R.city_alert(), schema, *rows)
    assert got == [S.ALERT_POLLUTION_TRAP, S.ALERT_ROAD_CLOSED, S.ALERT_ALL_CLEAR,
                   S.ALERT_ALL_CLEAR, S.ALERT_POLLUTION_TRAP, S.ALERT_ROAD_CLOSED]
    assert S.ALERT_POLLUTION_TRAP == "\U0001F534 POLLUTION TRAP"
    assert S.ALERT_ROAD_CLOSED == "⚠️ ROAD CLOSED"
    assert S.ALERT_ALL_CLEAR == "\U0001F7E2 ALL CLEAR"


def test_alert_severity(spark):
    rows = [(S.ALERT_POLLUTION_TRAP,), (S.ALERT_ROAD_CLOSED,), (S.ALERT_ALL_CLEAR,), (None,)]
    assert one(spark, R.alert_severity("a"), "a string", *rows) == ["red", "amber", "green", "green"]


@pytest.mark.parametrize("raw,norm", [(" FC ROAD ", "fc road"), ("Kothrud", "kothrud"),
                                      ("\tHadapsar", "\thadapsar"), (None, None), ("  ", "")])
def test_zone_normalisation(spark, raw, norm):
    assert one(spark, R.normalize_zone("z"), "z string", (raw,)) == [norm]
