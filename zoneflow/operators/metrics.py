"""Dashboard queries over the unified-document history (PRJ-06, PRJ-10, WN-02, AG-01..AG-13,
ST-02, ST-03).

Each is one declarative plan over the history table: a range filter that reaches the scan, then
one aggregation (partial before the shuffle) or a top-k. No rows are collected.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow import schemas as S
from zoneflow.functions.rules import alert_severity
from zoneflow.functions.text import document_key, store_time_text
from zoneflow.functions.times import between_inclusive, check_range_minutes


def in_range(history: DataFrame, as_of: dt.datetime, range_minutes: int = S.RANGE_MINUTES_DEFAULT,
             time_col: str = "synchronized_time") -> DataFrame:
    """PRJ-06: ``as_of - range <= time <= as_of`` (both ends), range checked to 1..1440 minutes."""
    check_range_minutes(range_minutes)
    start = as_of - dt.timedelta(minutes=range_minutes)
    cond = between_inclusive(time_col, start, as_of)
    if "sync_date" in history.columns:  # a date-partitioned document table: prune dates too
        cond = cond & F.col("sync_date").between(F.lit(start.date()), F.lit(as_of.date()))
    return history.filter(cond)


def r1(c: Column) -> Column:
    """AG-12: one-decimal rounding; null stays null."""
    return F.round(c, 1)


def is_trap() -> Column:
    return F.col("city_alert") == S.ALERT_POLLUTION_TRAP


def is_closed() -> Column:
    return F.col("road_closure") == F.lit(True)


SUMMARY_MAPS = (("alerts", "city_alert"), ("aqi_statuses", "aqi_status"), ("traffic_statuses", "traffic_status"))


def summary(history: DataFrame, as_of: dt.datetime,
            range_minutes: int = S.RANGE_MINUTES_DEFAULT) -> DataFrame:
    """AG-01..04, AG-08, AG-11, AG-12: one row of KPIs with the value -> count maps of alerts, AQI and
    traffic statuses (one row, with empty maps, even when the range is empty).

    One scan: documents are first counted and summed per (zone, alert, statuses); that small table is
    then grouped as a whole (for the KPIs), by each status alone (for the maps) and by zone (whose rows are
    counted) by grouping sets, so nothing is counted distinctly.
    """
    statuses = [c for _, c in SUMMARY_MAPS]
    columns = ["zone", *statuses]
    small = in_range(history, as_of, range_minutes).groupBy("zone", *statuses).agg(
        F.count(F.lit(1)).alias("n"), F.max("aqi").cast("double").alias("max_aqi"),
        *[f(c).alias(f"{name}_{c}") for c in ("aqi", "congestion_pct", "temperature_c")
          for name, f in (("n", F.count), ("sum", F.sum))],
        F.count_if(is_closed()).alias("closed"), F.max("synchronized_time").alias("newest"))
    avg = {c: r1(F.sum(f"sum_{c}") / F.sum(f"n_{c}")) for c in ("aqi", "congestion_pct", "temperature_c")}
    sets = small.groupingSets([[], *[[c] for c in columns]], *columns).agg(
        F.grouping_id().alias("set"), F.sum("n").alias("n"), F.sum("n_aqi").alias("records"), avg["aqi"].alias("avg_aqi"), F.max("max_aqi").alias("max_aqi"),
        avg["congestion_pct"].alias("avg_congestion"), avg["temperature_c"].alias("avg_temperature"),
        F.sum("closed").alias("closed"), F.max("newest").alias("newest"))
    # a grouping id has a bit for each column that a set leaves out, the first column's highest
    every = (1 << len(columns)) - 1
    whole = {c: F.max(F.when(F.col("set") == every, F.col(c)))
             for c in ("records", "avg_aqi", "max_aqi", "avg_congestion", "avg_temperature", "closed", "newest")}
    alone = {c: F.col("set") == every - (1 << (len(columns) - 1 - i)) for i, c in enumerate(columns)}
    traps = F.sum(F.when(alone["city_alert"] & is_trap(), F.col("n")))
    maps = [F.map_from_entries(F.array_sort(F.collect_list(F.when(
        alone[c] & F.col(c).isNotNull(), F.struct(F.col(c).alias("name"), F.col("n").alias("value"))))))
        .alias(name) for name, c in SUMMARY_MAPS]
    zero = F.lit(0).cast("bigint")
    return sets.agg(
        F.count_if(alone["zone"] & F.col("zone").isNotNull()).alias("zone_count"),
        F.coalesce(whole["records"], zero).alias("record_count"),
        whole["avg_aqi"].alias("avg_aqi"), r1(whole["max_aqi"]).alias("max_aqi"),
        whole["avg_congestion"].alias("avg_congestion"), whole["avg_temperature"].alias("avg_temperature"),
        F.coalesce(traps, zero).alias("pollution_trap_count"),
        F.coalesce(whole["closed"], zero).alias("road_closure_count"),
        store_time_text(whole["newest"]).alias("last_updated"), *maps)


def zone_analytics(history: DataFrame, as_of: dt.datetime,
                   range_minutes: int = S.RANGE_MINUTES_DEFAULT,
                   size: int | None = None) -> DataFrame:
    """AG-05, AG-10: ten metrics per zone, zones A to Z; the first ``size`` zones if that is given."""
    r = in_range(history, as_of, range_minutes).filter(F.col("zone").isNotNull())
    zones = (r.groupBy("zone").agg(
        F.count(F.lit(1)).alias("record_count"),
        r1(F.avg("aqi")).alias("avg_aqi"),
        r1(F.max("aqi").cast("double")).alias("max_aqi"),
        r1(F.avg("congestion_pct")).alias("avg_congestion"),
        r1(F.max("congestion_pct")).alias("max_congestion"),
        r1(F.avg("current_speed_kmph")).alias("avg_speed"),
        r1(F.avg("temperature_c")).alias("avg_temperature"),
        r1(F.avg("humidity_pct")).alias("avg_humidity"),
        r1(F.coalesce(F.sum("rainfall_mm"), F.lit(0.0))).alias("total_rainfall"),
        F.count_if(is_trap()).alias("pollution_trap_count"),
        F.count_if(is_closed()).alias("road_closure_count"),
    ).orderBy("zone"))
    return zones if size is None else zones.limit(size)


STATUS_DIMENSIONS = (("alerts", "city_alert"), ("aqi_statuses", "aqi_status"),
                     ("traffic_statuses", "traffic_status"),
                     ("weather_conditions", "weather_condition"))


def value_counts(df: DataFrame, dimensions=STATUS_DIMENSIONS, size: int | None = None) -> DataFrame:
    """AG-06/07, ST-03: per dimension, the non-null values by frequency (count desc, value asc), as
    (dimension, name, value, rank) rows; the ``size`` most frequent ones if that is given.

    Documents are counted by all dimensions together first (a handful of combinations); only these
    are stacked, one row a dimension, and counted again and ranked.
    """
    columns = [c for _, c in dimensions]
    combined = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    stacked = combined.select("n", F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(c).cast("string").alias("name"))
        for d, c in dimensions])).alias("s")).select("s.*", "n")
    counts = (stacked.filter(F.col("name").isNotNull())
              .groupBy("dimension", "name").agg(F.sum("n").alias("value")))
    w = Window.partitionBy("dimension").orderBy(F.col("value").desc(), F.col("name"))
    ranked = counts.withColumn("rank", F.row_number().over(w))
    return ranked if size is None else ranked.filter(F.col("rank") <= size)


#: Values that a summary of frequent values holds; each counts at most 3.5 / this share of all rows too little or too much.
TRACKED_VALUES = 8192


def top_values(df: DataFrame, column: str, size: int, tracked: int = TRACKED_VALUES) -> DataFrame:
    """AG-06 over a column of any number of values: the ``size`` most frequent non-null ones as (name, value, rank), exact, counted
    without shuffling all values.

    A mergeable summary of frequent values names candidates; they are counted exactly in a second scan, which broadcasts them (``tracked``
    values at most) and shuffles their partial counts only. A value that the summary does not name has at most the summary's error;
    if the last of the top does not exceed it, the values are too even for the summary, and all are counted.
    """
    named = df.select(F.col(column).cast("string").alias("name")).filter("name IS NOT NULL")
    summary = named.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(name, {int(tracked)}, {int(tracked)})").alias("items"))
    total, items = summary.first()
    order = (F.col("value").desc(), F.col("name"))
    rows = []
    if total:
        names = df.sparkSession.createDataFrame([(i["item"],) for i in items], "name string")  # ``tracked`` at most
        counted = named.join(F.broadcast(names), "name", "left_semi").groupBy("name").agg(F.count(F.lit(1)).alias("value")).persist()
        try:
            rows = counted.orderBy(*order).limit(size).collect()
            missing = total - (counted.agg(F.sum("value")).first()[0] or 0)
        finally:
            counted.unpersist()
        if missing and (len(rows) < size or rows[-1].value <= 3.5 / tracked * total):
            rows = named.groupBy("name").agg(F.count(F.lit(1)).alias("value")).orderBy(*order).limit(size).collect()
    return df.sparkSession.createDataFrame([(r.name, r.value, i) for i, r in enumerate(rows, 1)], "name string, value bigint, rank int")


def status_breakdown(history: DataFrame, as_of: dt.datetime,
                     range_minutes: int = S.RANGE_MINUTES_DEFAULT, size: int | None = None) -> DataFrame:
    """AG-07: alerts, AQI, traffic and weather statuses -> (dimension, name, value, rank)."""
    return value_counts(in_range(history, as_of, range_minutes), size=size)


def summary_maps(history: DataFrame, as_of: dt.datetime,
                 range_minutes: int = S.RANGE_MINUTES_DEFAULT) -> DataFrame:
    """AG-08: the summary's value -> count maps (alerts, AQI statuses, traffic statuses), one row a
    dimension, with all values. Values are counted before they are gathered."""
    counts = value_counts(in_range(history, as_of, range_minutes), SUMMARY_MAPS)
    return (counts.groupBy("dimension")
            .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value"))))
                 .alias("counts")))


def trends(history: DataFrame, as_of: dt.datetime, range_minutes: int = S.RANGE_MINUTES_DEFAULT,
           bucket: str = S.TREND_BUCKET) -> DataFrame:
    """AG-09: epoch-aligned buckets (empty ones left out), four averages and the trap count.

    ``time`` is the bucket start as the store prints a histogram key (UTC, milliseconds, ``Z``);
    rows come in bucket order."""
    r = in_range(history, as_of, range_minutes)
    return (r.groupBy(F.window("synchronized_time", bucket).alias("w")).agg(
        F.count(F.lit(1)).alias("record_count"),
        r1(F.avg("aqi")).alias("avg_aqi"),
        r1(F.avg("congestion_pct")).alias("avg_congestion"),
        r1(F.avg("current_speed_kmph")).alias("avg_speed"),
        r1(F.avg("temperature_c")).alias("avg_temperature"),
        F.count_if(is_trap()).alias("pollution_trap_count"),
    ).orderBy("w.start")
     .select(store_time_text(F.col("w.start")).alias("time"), "record_count", "avg_aqi",
             "avg_congestion", "avg_speed", "avg_temperature", "pollution_trap_count"))


def newest(history: DataFrame, n: int) -> DataFrame:
    """ST-02: the ``n`` newest documents; (synchronized_time, zone) makes the order unique."""
    return history.orderBy(F.col("synchronized_time").desc(), F.col("zone")).limit(n)


def latest_documents(history: DataFrame, as_of: dt.datetime,
                     range_minutes: int = S.RANGE_MINUTES_DEFAULT,
                     scan_limit: int | None = None) -> DataFrame:
    """WN-02: newest document per zone in range; among the newest ``scan_limit`` if that is given."""
    r = in_range(history, as_of, range_minutes)
    if scan_limit is not None:
        r = newest(r, scan_limit)
    w = Window.partitionBy("zone").orderBy(F.col("synchronized_time").desc())
    return (r.filter(F.col("zone").isNotNull() & (F.col("zone") != ""))
            .withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def zones_online(history: DataFrame, as_of: dt.datetime,
                 range_minutes: int = S.RANGE_MINUTES_DEFAULT) -> DataFrame:
    """AG-13: how many zones have a document in range."""
    named = in_range(history, as_of, range_minutes).filter(F.col("zone") != "")
    return named.agg(F.count_distinct("zone").alias("zones_online"))


def alert_documents(history: DataFrame, as_of: dt.datetime,
                    range_minutes: int = S.RANGE_MINUTES_DEFAULT) -> DataFrame:
    """PRJ-10 + SC-14: documents with a pollution trap or a closed road, with the badge colour."""
    r = in_range(history, as_of, range_minutes).filter(is_trap() | is_closed())
    return r.select(document_key().alias("doc_id"), "zone", "synchronized_time", "city_alert",
                    "road_closure", alert_severity().alias("severity"))


def distinct_zones(history: DataFrame, as_of: dt.datetime,
                   range_minutes: int = S.RANGE_MINUTES_DEFAULT) -> DataFrame:
    """AG-03: distinct zone texts and distinct normalised zones, exact."""
    r = in_range(history, as_of, range_minutes)
    return r.agg(F.count_distinct("zone").alias("zone_count"),
                 F.count_distinct(F.lower(F.trim("zone"))).alias("norm_zone_count"))


def conditional_counts(history: DataFrame, as_of: dt.datetime,
                       range_minutes: int = S.RANGE_MINUTES_DEFAULT) -> DataFrame:
    """AG-02/04: non-null AQI count and filtered counts per synchronized time."""
    r = in_range(history, as_of, range_minutes)
    return r.groupBy("synchronized_time").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count("aqi").alias("aqi_values"),
        F.count_if(is_trap()).alias("pollution_trap_count"),
        F.count_if(is_closed()).alias("road_closure_count"),
    )


def last_update(history: DataFrame, as_of: dt.datetime,
                range_minutes: int = S.RANGE_MINUTES_DEFAULT) -> DataFrame:
    """AG-11: newest synchronized time in range, as a timestamp and as ISO text."""
    r = in_range(history, as_of, range_minutes)
    return r.agg(F.max("synchronized_time").alias("last_updated_time")).select(
        "last_updated_time", store_time_text("last_updated_time").alias("last_updated"))
