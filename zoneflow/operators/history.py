"""Trigger-history replay (JN-03): what the unified stream would have emitted at every trigger.

At each non-empty tick (a tick in which any message arrived), every zone that has seen all three
feeds is emitted once with its newest reading of each feed as of the end of the tick;
``synchronized_time`` is the tick end. This is an as-of join of ticks against three reading
streams, built from shuffles, joins and windows:

1. one aggregation reduces the messages to the newest raw message per (zone, tick, feed) - partial
   aggregation before the shuffle, so a hot zone sends one row per map task and tick; the winners
   are parsed and written as a table in the shared folder, which the later steps read pruned.
   With ``since``, all earlier messages fall into one tick before the range: the table then holds a
   zone's carried-in state and the ticks of the range, whatever the age of the history;
2. the (zone, tick) grid: each zone's ticks from its first one on, equi-joined with the non-empty
   ticks on the tick itself;
3. the newest reading is carried forward with ``last(..., ignorenulls)`` over windows partitioned
   by (zone, segment), so no task holds a zone's whole history; each segment starts from a
   carry-in computed on the small per-(zone, segment) table. Carry-in, reading and grid rows
   are one union, shuffled once on (zone, segment): the grid is never joined to the readings.

Readings are carried as whole structs, so a null field in the newest reading is never filled
from an older one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.functions.times import ntz, tick_at_or_after, tick_length
from zoneflow.session import intermediate_path
from zoneflow.operators import latest as L
from zoneflow.operators import parse as P
from zoneflow.operators import unify as U

_SEGMENT_UNITS = {"hour": "HOUR", "day": "DAY", "week": "WEEK", "month": "MONTH"}


def _segment_of(col, segment: str):
    return F.date_trunc(_SEGMENT_UNITS[segment], col)


def per_tick_latest(messages: DataFrame, tick: str, until: dt.datetime,
                    since: dt.datetime | None = None) -> DataFrame:
    """Newest reading per (zone, tick) and feed, of ticks that end by ``until``; also keeps ticks
    whose messages had no zone. Messages of ticks that end before ``since`` share one tick, the
    last one before it."""
    end = F.window("kafka_time", tick).end
    keyed = (messages.filter(F.col("kafka_time") < ntz(until))
             .withColumn("norm_zone", P.zone_of_payload())
             .withColumn("synchronized_time", end))
    if since is not None:
        before = ntz(tick_at_or_after(since, tick) - tick_length(tick))
        keyed = keyed.withColumn("synchronized_time", F.greatest("synchronized_time", before))
    newest = L.newest_raw(keyed, ("norm_zone", "synchronized_time")).filter(
        F.col("synchronized_time") <= ntz(until))
    return P.parse_newest(newest, ("norm_zone", "synchronized_time", "_zone_ok"))


def replay_states(messages: DataFrame, until: dt.datetime, tick: str = "1 hour",
                  segment: str = "day", since: dt.datetime | None = None) -> DataFrame:
    """(norm_zone, synchronized_time, aqi_reading, traffic_reading, weather_reading) for every
    non-empty tick ending at or before ``until`` (and at or after ``since``), from each zone's
    first tick on.

    The per-tick table (zones x ticks rows, small next to the messages) feeds four branches. It is
    written to the shared folder, so the messages are scanned once, each branch reads only its
    columns, and a lost executor recomputes from the table, not the source; the folder is removed
    when the application ends.
    """
    spark = messages.sparkSession
    per_tick = per_tick_latest(messages, tick, until, since)
    path = intermediate_path(spark, "per-tick")
    per_tick.write.parquet(path)
    per_tick = spark.read.schema(per_tick.schema).parquet(path)
    ticks = per_tick.select("synchronized_time").distinct()
    readings = per_tick.filter(F.col("_zone_ok")).drop("_zone_ok")
    first_ticks = (readings.groupBy("norm_zone")
                   .agg(F.min("synchronized_time").alias("first_tick")))
    if since is not None:
        start = ntz(tick_at_or_after(since, tick))
        ticks = ticks.filter(F.col("synchronized_time") >= start)
        first_ticks = first_ticks.withColumn("first_tick", F.greatest("first_tick", start))
    # Ticks are epoch-aligned, so every zone's sequence meets the non-empty ticks; a zone whose
    # first tick lies after ``until`` has none.
    last = ntz(until)
    first_ticks = first_ticks.filter(F.col("first_tick") <= last)
    grid = (first_ticks.select("norm_zone", F.explode(F.sequence(
                "first_tick", last, F.expr(f"INTERVAL {tick}"))).alias("synchronized_time"))
            .join(ticks, "synchronized_time")
            .withColumn("segment", _segment_of(F.col("synchronized_time"), segment)))

    step = F.expr(f"INTERVAL 1 {_SEGMENT_UNITS[segment]}")
    first_ticks = (readings.groupBy("norm_zone")
                   .agg(F.min("synchronized_time").alias("first_tick")))
    zone_segments = first_ticks.select("norm_zone", F.explode(F.sequence(
        _segment_of(F.col("first_tick"), segment), _segment_of(last, segment), step)).alias("segment"))

    # Newest reading of each feed per (zone, segment), then carried in from earlier segments.
    seg_last = (readings.withColumn("segment", _segment_of(F.col("synchronized_time"), segment))
                .groupBy("norm_zone", "segment")
                .agg(*[F.max_by(F.col(r), F.when(F.col(r).isNotNull(), F.col("synchronized_time")))
                       .alias(r) for r in L.READINGS]))
    types = {r: readings.schema[r].dataType for r in (*L.READINGS, "synchronized_time")}
    nulls = [F.lit(None).cast(types[r]).alias(r) for r in L.READINGS]
    # The zone's segments and its per-segment newest readings in one union, shuffled once on the
    # zone: a segment row sorts before that segment's readings, so its running last() sees the
    # readings of earlier segments only.
    before = (Window.partitionBy("norm_zone").orderBy("segment", "_kind")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carry_in = (zone_segments.select("norm_zone", "segment", F.lit(0).alias("_kind"), *nulls)
                .unionByName(seg_last.select("norm_zone", "segment", F.lit(1).alias("_kind"),
                                             *L.READINGS))
                .select("norm_zone", "segment", "_kind",
                        *[F.last(r, ignorenulls=True).over(before).alias(f"_in_{r}")
                          for r in L.READINGS])
                .filter(F.col("_kind") == 0).drop("_kind"))

    # Carry-in rows (at the segment start), reading rows and grid rows in one union, shuffled
    # once on (zone, segment): within a tick the carry-in and the reading sort before the grid
    # row, so the grid row's running last() sees them. No join on the grid's size.
    kind = {"carry": 0, "reading": 1, "grid": 2}
    rows = (carry_in.select("norm_zone", "segment",
                            F.col("segment").cast(types["synchronized_time"]).alias("synchronized_time"),
                            F.lit(kind["carry"]).alias("_kind"),
                            *[F.col(f"_in_{r}").alias(r) for r in L.READINGS])
            .unionByName(readings.select(
                "norm_zone", _segment_of(F.col("synchronized_time"), segment).alias("segment"),
                "synchronized_time", F.lit(kind["reading"]).alias("_kind"), *L.READINGS))
            .unionByName(grid.select(
                "norm_zone", "segment", "synchronized_time", F.lit(kind["grid"]).alias("_kind"),
                *nulls)))
    so_far = (Window.partitionBy("norm_zone", "segment").orderBy("synchronized_time", "_kind")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = (rows.select("norm_zone", "synchronized_time", "_kind",
                          *[F.last(r, ignorenulls=True).over(so_far).alias(r) for r in L.READINGS])
              .filter(F.col("_kind") == kind["grid"]).drop("_kind"))
    return L.complete(filled)


def replay_history(messages: DataFrame, until: dt.datetime, tick: str = "1 hour",
                   segment: str = "day", zones: DataFrame | None = None,
                   since: dt.datetime | None = None, carry=None) -> DataFrame:
    """The unified documents (41 columns) of every tick, as the stream would have written them.

    With ``since`` and ``carry`` (``sinks.carry.CarryTable``), messages before the newest boundary that the range
    allows are not read: the table has what they left. The documents are the same."""
    if carry is not None:
        if since is None:
            raise ValueError("a carry-in table bounds a replay that has a start")
        messages = carry.messages_since(messages, tick_at_or_after(since, tick) - tick_length(tick))
    states = replay_states(messages, until, tick, segment, since)
    rows = L.expand_readings(states, extra=("synchronized_time",))
    if zones is not None:
        rows = U.known_zones_only(rows, zones)
    return U.unified_rows(rows, F.col("synchronized_time"))
