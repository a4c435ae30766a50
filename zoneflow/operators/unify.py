"""Unified snapshot: latest per zone per feed, joined on zone, with rules (JN-01, PRJ-05, PRJ-07,
PRJ-09, ST-01, AG-14)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow import schemas as S
from zoneflow.functions.rules import unified_rule_columns
from zoneflow.functions.times import ntz
from zoneflow.operators import latest as L
from zoneflow.operators import parse as P
from zoneflow.sources.kafka import within_lookback


def expected_zones(spark: SparkSession, zones: tuple[str, ...] = S.EXPECTED_ZONES) -> DataFrame:
    """The known-zone dimension (normalised names); a fixed handful of rows."""
    return spark.createDataFrame([(z,) for z in zones], "norm_zone string")


def known_zones_only(df: DataFrame, zones: DataFrame) -> DataFrame:
    """PRJ-07: keep rows whose ``norm_zone`` is in the zone dimension (left-semi; Spark broadcasts
    the dimension if it is small in bytes)."""
    return df.join(zones, "norm_zone", "left_semi")


def join_latest(messages: DataFrame) -> DataFrame:
    """JN-01: newest reading per zone for each feed, inner-joined on ``norm_zone``.

    Each side routes its topic, parses that feed alone and keeps the newest message per zone; Spark
    puts a partial ``WindowGroupLimit`` before each shuffle, so a map task sends at most one row
    per zone. The sides arrive partitioned by zone, so the joins add no shuffle of their own.
    ``latest.latest_readings`` gives the same rows from one scan (the snapshot uses that).
    """
    aqi, traffic, weather = (
        L.latest_by_zone(P.parse_feed(messages, t), S.FEED_PREFIX[t]) for t in S.TOPICS)
    traffic = traffic.withColumnRenamed("norm_zone", "_z_traffic")
    weather = weather.withColumnRenamed("norm_zone", "_z_weather")
    # Null zones are already gone; a null-safe key keeps Catalyst from inferring an
    # ``isnotnull(zone)`` filter and pushing it (and a second JSON parse) into the scan.
    return (aqi.join(traffic, aqi["norm_zone"].eqNullSafe(traffic["_z_traffic"]), "inner")
            .join(weather, aqi["norm_zone"].eqNullSafe(weather["_z_weather"]), "inner")
            .drop("_z_traffic", "_z_weather"))


def unified_rows(joined: DataFrame, synchronized_time: Column) -> DataFrame:
    """PRJ-05/09 + SC-02..07: the 41-column unified row, in one projection."""
    computed = {"synchronized_time": synchronized_time, **unified_rule_columns()}
    return joined.select(*[computed[c].alias(c) if c in computed else F.col(c)
                           for c in S.UNIFIED_COLUMNS])


def as_of_literal(as_of: dt.datetime) -> Column:
    """A fixed processing time (``timestamp_ntz``), constant for the whole batch."""
    return ntz(as_of)


def unified_snapshot(messages: DataFrame, as_of: dt.datetime,
                     zones: DataFrame | None = None) -> DataFrame:
    """The batch unified job: one row per complete zone, sorted by zone (ST-01).

    Same rows as the three-window-and-join form (``join_latest``), from one scan and one shuffle,
    parsing only the winners in full: the latest-state aggregate of ``latest.latest_readings``.
    """
    state = L.latest_readings(messages)
    return unified_from_state(state, as_of_literal(as_of), zones).orderBy("zone")


def unified_snapshot_joined(messages: DataFrame, as_of: dt.datetime,
                            zones: DataFrame | None = None) -> DataFrame:
    """JN-01 form of the snapshot: three latest-per-zone windows joined on zone."""
    joined = join_latest(messages)
    if zones is not None:
        joined = known_zones_only(joined, zones)
    return unified_rows(joined, as_of_literal(as_of)).orderBy("zone")


def unified_from_state(latest: DataFrame, synchronized_time: Column,
                       zones: DataFrame | None = None) -> DataFrame:
    """The same rows from the JN-02 latest-state aggregate (used by the stream)."""
    rows = L.expand_readings(L.complete(latest))
    if zones is not None:
        rows = known_zones_only(rows, zones)
    return unified_rows(rows, synchronized_time)


def warmup_coverage(latest: DataFrame, zones: DataFrame) -> DataFrame:
    """AG-14: per expected zone, which feeds have been seen, and whether the zone is complete.

    Then one row: complete zones vs expected zones.
    """
    seen = zones.join(latest, "norm_zone", "left")
    flags = [F.col(r).isNotNull().alias(f"has_{r.split('_')[0]}") for r in L.READINGS]
    per_zone = seen.select("norm_zone", *flags)
    return per_zone.agg(
        F.count(F.lit(1)).alias("expected_zones"),
        F.count_if(F.col("has_aqi") & F.col("has_traffic") & F.col("has_weather"))
        .alias("complete_zones"),
        F.count_if("has_aqi").alias("zones_with_aqi"),
        F.count_if("has_traffic").alias("zones_with_traffic"),
        F.count_if("has_weather").alias("zones_with_weather"),
    )


class NothingComplete(RuntimeError):
    """No zone has all three feeds in the range of a batch run."""


def scheduled_batch(messages: DataFrame, as_of: dt.datetime, lookback_minutes: int, write, batch_id: int,
                    write_rejects=None, zones: DataFrame | None = None) -> None:
    """STR-08: one run of the scheduled job over the messages of ``as_of - lookback .. as_of``.

    The newest readings are merged per zone; ``write(documents, batch_id)`` takes the documents of
    complete zones (``sinks.documents.DocumentSink``) and ``write_rejects(rejects, batch_id)`` the
    faulty messages with their reason (one with a field of a wrong type still counts as a reading
    without that field). Raises ``NothingComplete``, and writes no documents, if no zone is complete.
    Runs may overlap: a run replaces its own batch, and the newest version of a document wins.
    """
    ranged = within_lookback(messages, as_of, lookback_minutes)
    if write_rejects is not None:
        write_rejects(P.rejected_messages(ranged), batch_id)
    documents = unified_snapshot(ranged, as_of, zones).persist()  # a row a zone, read twice
    try:
        if documents.isEmpty():
            raise NothingComplete(f"no zone with all three feeds in the {lookback_minutes} minutes up to {as_of}")
        write(documents, batch_id)
    finally:
        documents.unpersist()
