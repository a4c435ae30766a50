"""Rule columns: zone normalisation, statuses, alerts (SC-01..SC-07, SC-14).

All are built-in column expressions, so they stay inside whole-stage codegen and work the same in
batch and streaming plans. A null input falls to the last branch of each chain, like a SQL CASE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zoneflow import schemas as S


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_zone(zone: str | Column) -> Column:
    """SC-01: ``lower(trim(zone))``. Spark's ``trim`` removes spaces only, not tabs."""
    return F.lower(F.trim(_c(zone)))


def aqi_status(aqi: str | Column = "aqi") -> Column:
    """SC-02."""
    a = _c(aqi)
    return (F.when(a > S.AQI_HAZARDOUS_ABOVE, S.AQI_HAZARDOUS)
            .when(a > S.AQI_SEVERE_ABOVE, S.AQI_SEVERE)
            .when(a > S.AQI_UNHEALTHY_ABOVE, S.AQI_UNHEALTHY)
            .otherwise(S.AQI_ACCEPTABLE))


def aqi_alert(aqi: str | Column = "aqi") -> Column:
    """SC-03: AQI above the alert level; null is no alert."""
    return F.when(_c(aqi) > S.AQI_ALERT_ABOVE, True).otherwise(False)


def traffic_status(road_closure: str | Column = "road_closure",
                   congestion_pct: str | Column = "congestion_pct") -> Column:
    """SC-04."""
    closed, cong = _c(road_closure), _c(congestion_pct)
    return (F.when(closed == F.lit(True), S.TRAFFIC_BLOCKAGE)
            .when(cong > S.CONGESTION_HEAVY_ABOVE, S.TRAFFIC_HEAVY)
            .when(cong > S.CONGESTION_MODERATE_ABOVE, S.TRAFFIC_MODERATE)
            .otherwise(S.TRAFFIC_FREE))


def traffic_alert(road_closure: str | Column = "road_closure",
                  current_speed_kmph: str | Column = "current_speed_kmph") -> Column:
    """SC-05: closed, or slower than the alert speed (``null OR true`` is true)."""
    cond = ((_c(road_closure) == F.lit(True))
            | (_c(current_speed_kmph) < S.TRAFFIC_ALERT_SPEED_BELOW))
    return F.when(cond, True).otherwise(False)


def weather_condition(rainfall_mm: str | Column = "rainfall_mm",
                      temperature_c: str | Column = "temperature_c") -> Column:
    """SC-06."""
    return (F.when(_c(rainfall_mm) > S.HEAVY_RAIN_ABOVE_MM, S.WEATHER_HEAVY_RAIN)
            .when(_c(temperature_c) > S.EXTREME_HEAT_ABOVE_C, S.WEATHER_EXTREME_HEAT)
            .otherwise(S.WEATHER_NORMAL))


def city_alert(aqi: str | Column = "aqi", congestion_pct: str | Column = "congestion_pct",
               road_closure: str | Column = "road_closure") -> Column:
    """SC-07: first matching rule wins."""
    trap = (_c(aqi) > S.AQI_ALERT_ABOVE) & (_c(congestion_pct) > S.CONGESTION_HEAVY_ABOVE)
    return (F.when(trap, S.ALERT_POLLUTION_TRAP)
            .when(_c(road_closure) == F.lit(True), S.ALERT_ROAD_CLOSED)
            .otherwise(S.ALERT_ALL_CLEAR))


def alert_severity(city_alert_col: str | Column = "city_alert") -> Column:
    """SC-14: badge colour of an alert text."""
    a = _c(city_alert_col)
    return (F.when(a.contains("POLLUTION"), S.SEVERITY_RED)
            .when(a.contains("ROAD"), S.SEVERITY_AMBER)
            .otherwise(S.SEVERITY_GREEN))


def unified_rule_columns() -> dict[str, Column]:
    """The four rule columns of a unified row, by output name."""
    return {"aqi_status": aqi_status(), "traffic_status": traffic_status(),
            "weather_condition": weather_condition(), "city_alert": city_alert()}
