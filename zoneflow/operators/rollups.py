"""Mergeable rollups of the document history (AG-01..05, AG-07..12) and distinct-count sketches (AG-03).

A rollup row holds what the dashboard's queries need of a zone's documents in one time bucket: counts, sums, maxima, the newest
time, and the counts of status combinations. Such rows merge: a coarser bucket is the merge of finer ones, and a range is the
merge of the coarse buckets inside it, the finer ones next to them, and the documents of its two ragged ends. So a query
over a long range reads a few rows a zone instead of every document, and gives the same answers.

``RollupTable`` keeps the levels as keyed tables (``sinks.documents.DocumentSink``: one row a zone and bucket, the newest version
counts), updated for the buckets that a batch of documents touches. A bucket is always recomputed from the current
documents, so replayed, corrected and replaced documents never count twice.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zoneflow import schemas as S
from zoneflow.functions.text import store_time_text
from zoneflow.functions.times import between_inclusive, check_range_minutes, ntz, tick_at_or_after, tick_length
from zoneflow.operators import metrics as M
from zoneflow.sinks.documents import DATE_COL, DocumentSink

#: From fine to coarse; each length divides the next, and the finest is the trends' bucket.
LEVELS = (S.TREND_BUCKET, "1 hour")
AVERAGED = ("aqi", "congestion_pct", "current_speed_kmph", "temperature_c", "humidity_pct", "rainfall_mm")
GREATEST = ("aqi", "congestion_pct")
STATUSES = tuple(c for _, c in M.STATUS_DIMENSIONS)
KEY = ("zone", "synchronized_time")

_STATUS_SCHEMA = f"array<struct<{','.join(f'{c}:string' for c in STATUSES)},n:bigint>>"
ROLLUP_DDL = ("zone string, synchronized_time timestamp_ntz, n bigint, closed bigint, newest timestamp_ntz, "
              + ", ".join(f"n_{c} bigint, sum_{c} double" for c in AVERAGED) + ", "
              + ", ".join(f"max_{c} double" for c in GREATEST) + f", statuses {_STATUS_SCHEMA}")


def bucket_of(time: str | Column, bucket: str) -> Column:
    """Start of the epoch-aligned bucket."""
    return F.window(time, bucket).start


def _measures() -> list[Column]:
    return [F.sum("n").alias("n"), F.sum("closed").alias("closed"), F.max("newest").alias("newest"),
            *[F.sum(f"{f}_{c}").alias(f"{f}_{c}") for c in AVERAGED for f in ("n", "sum")],
            *[F.max(f"max_{c}").alias(f"max_{c}") for c in GREATEST]]


def _gathered(by_status: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row a key from one row a key and status combination (a handful of combinations a key)."""
    pairs = F.collect_list(F.struct(*STATUSES, "n"))
    return by_status.groupBy(*keys).agg(*_measures(), F.array_sort(pairs).cast(_STATUS_SCHEMA).alias("statuses"))


def rollup_rows(documents: DataFrame, bucket: str) -> DataFrame:
    """Rollup rows of documents: counted by zone, bucket and status combination first (partial before the shuffle)."""
    rows = documents.select("zone", *STATUSES, *AVERAGED, F.col("road_closure"), "synchronized_time",
                            bucket_of("synchronized_time", bucket).alias("_start"))
    counted = rows.groupBy("zone", F.col("_start").alias("start"), *STATUSES).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(M.is_closed()).alias("closed"), F.max("synchronized_time").alias("newest"),
        *[f(F.col(c).cast("double")).alias(f"{name}_{c}") for c in AVERAGED for name, f in (("n", F.count), ("sum", F.sum))],
        *[F.max(F.col(c).cast("double")).alias(f"max_{c}") for c in GREATEST]).withColumnRenamed("start", "synchronized_time")
    return _gathered(counted, KEY)


def merged(rollups: DataFrame, bucket: str) -> DataFrame:
    """Rollup rows of a coarser bucket."""
    coarse = rollups.withColumn("synchronized_time", bucket_of("synchronized_time", bucket))
    measures = coarse.groupBy(*KEY).agg(*_measures())
    combos = (coarse.select(*KEY, F.explode("statuses").alias("s")).select(*KEY, "s.*")
              .groupBy(*KEY, *STATUSES).agg(F.sum("n").alias("n"))
              .groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct(*STATUSES, "n"))).alias("statuses")))
    same = measures["zone"].eqNullSafe(combos["zone"]) & (measures["synchronized_time"] == combos["synchronized_time"])
    return measures.join(combos, same).select(*[measures[c] for c in measures.columns], combos["statuses"])


class BucketTable:
    """Rows per time bucket at several levels, as keyed tables at ``path``: one table a level, one row a key.

    ``build(documents, bucket)`` makes rows of documents, ``merge(rows, bucket)`` rows of a coarser bucket."""

    def __init__(self, path: str, levels: tuple[str, ...], ddl: str, key: tuple[str, ...], build, merge, writer: str = "main"):
        lengths = [tick_length(b) for b in levels]
        if any(b % a for a, b in zip(lengths, lengths[1:])):
            raise ValueError("each level has to divide the next one")
        self.levels, self.key, self.build, self.merge = levels, key, build, merge
        self.schema = StructType.fromDDL(ddl)
        self.tables = [DocumentSink(f"{path.rstrip('/')}/level={i}", schema=self.schema, writer=writer) for i in range(len(levels))]

    def _read(self, spark: SparkSession, level: int) -> DataFrame:
        return self.tables[level].read(spark, key=self.key, keep_date=True)

    def update(self, spark: SparkSession, documents: DocumentSink, batch: DataFrame, batch_id: int) -> None:
        """Bring the buckets that ``batch`` (documents just written to ``documents``) touches up to date.

        Only the documents of the touched dates are read; each coarser level reads the finer one's rows."""
        others = [c for c in self.key if c != "synchronized_time"]
        for i, level in enumerate(self.levels):
            touched = batch.select(*others, bucket_of("synchronized_time", level).alias("_at")).distinct()
            first, last = touched.agg(F.min("_at"), F.max("_at")).first()
            if first is None:
                return
            source = self._read(spark, i - 1) if i else documents.read(spark, keep_date=True)
            source = _between(source, first, last + tick_length(level)).withColumn("_start", bucket_of("synchronized_time", level))
            keys = touched.select(*[F.col(c).alias(f"_{c}") for c in others], "_at")
            same = reduce(lambda x, c: x & F.col(c).eqNullSafe(F.col(f"_{c}")), others, F.col("_start") == F.col("_at"))
            source = source.join(keys, same, "left_semi").drop("_start")
            self.tables[i].write(self.merge(source, level) if i else self.build(source, level), batch_id)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold the rows of batches up to ``upto`` (see ``DocumentSink.compact``)."""
        for table in self.tables:
            table.compact(spark, upto, self.key)

    def range_rows(self, spark: SparkSession, documents: DocumentSink, as_of: dt.datetime, range_minutes: int,
                   coarsest: int | None = None) -> DataFrame:
        """Rows that together cover ``as_of - range .. as_of`` (both ends included): whole coarse buckets (``coarsest``: the level to
        begin with), then finer ones up to where they start and from where they end, then rows made of the documents of the last,
        ragged bits."""
        check_range_minutes(range_minutes)
        start = as_of - dt.timedelta(minutes=range_minutes)
        parts, inner = [], None  # inner: what is covered so far
        for i in range(len(self.levels) if coarsest is None else coarsest + 1)[::-1]:
            low, high = tick_at_or_after(start, self.levels[i]), tick_at_or_after(as_of, self.levels[i])
            if high > as_of:
                high -= tick_length(self.levels[i])
            if low >= high:
                continue
            table = self._read(spark, i)
            parts += [_between(table, a, b) for a, b in ([(low, high)] if inner is None else [(low, inner[0]), (inner[1], high)]) if a < b]
            inner = (low, high)
        docs = documents.read(spark, keep_date=True)
        if inner is not None and start < inner[0]:
            parts.append(self.build(_between(docs, start, inner[0]), self.levels[0]))
        rest = start if inner is None else inner[1]
        tail = _dates(docs, rest, as_of).filter(between_inclusive("synchronized_time", rest, as_of))
        parts.append(self.build(tail, self.levels[0]))
        return reduce(DataFrame.unionByName, [p.select(*self.schema.names) for p in parts])


class RollupTable(BucketTable):
    """AG-01, AG-02, AG-04, AG-05, AG-07..11: rollup rows a zone and bucket."""

    def __init__(self, path: str, levels: tuple[str, ...] = LEVELS, writer: str = "main"):
        super().__init__(path, levels, ROLLUP_DDL, KEY, rollup_rows, merged, writer)


class SketchTable(BucketTable):
    """AG-03: distinct-count sketches a bucket."""

    def __init__(self, path: str, levels: tuple[str, ...] = LEVELS[1:], writer: str = "main"):
        super().__init__(path, levels, SKETCH_DDL, ("synchronized_time",), sketch_rows, merged_sketches, writer)


def kept_up(documents: DocumentSink, *tables: BucketTable):
    """A ``foreachBatch`` sink that writes a batch of documents and then brings the tables up to date with it. A replayed batch
    replaces its documents and recomputes its buckets."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # one trigger's documents
        try:
            documents.write(batch, batch_id)
            for table in tables:
                table.update(batch.sparkSession, documents, batch, batch_id)
        finally:
            batch.unpersist()
    return write


def _dates(table: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    return table.filter(F.col(DATE_COL).between(F.lit(start.date()), F.lit(end.date())))


def _between(table: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    time = F.col("synchronized_time")
    return _dates(table, start, end).filter((time >= ntz(start)) & (time < ntz(end)))


def _mean(c: str) -> Column:
    return M.r1(F.sum(f"sum_{c}") / F.nullif(F.sum(f"n_{c}"), F.lit(0)))


def _with_traps(rollups: DataFrame) -> DataFrame:
    traps = F.aggregate(F.filter("statuses", lambda s: s["city_alert"] == S.ALERT_POLLUTION_TRAP), F.lit(0).cast("bigint"),
                        lambda total, s: total + s["n"])
    return rollups.withColumn("traps", traps)


def status_counts(rollups: DataFrame, dimensions=M.STATUS_DIMENSIONS) -> DataFrame:
    """(dimension, name, value): how many documents have each status."""
    combos = rollups.select(F.explode("statuses").alias("s")).select("s.*").groupBy(*STATUSES).agg(F.sum("n").alias("n"))
    return (combos.select("n", F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(c).alias("name"))
                                                   for d, c in dimensions])).alias("s")).select("s.*", "n")
            .filter("name IS NOT NULL").groupBy("dimension", "name").agg(F.sum("n").alias("value")))


def status_breakdown(rollups: DataFrame, size: int | None = None) -> DataFrame:
    """AG-07 from rollup rows."""
    w = Window.partitionBy("dimension").orderBy(F.col("value").desc(), F.col("name"))
    ranked = status_counts(rollups).withColumn("rank", F.row_number().over(w))
    return ranked if size is None else ranked.filter(F.col("rank") <= size)


def summary(rollups: DataFrame) -> DataFrame:
    """AG-01..04, AG-08, AG-11 from rollup rows: one row, also of an empty range. Rows are merged a zone first, so zones are counted
    from a row each."""
    zones = _with_traps(rollups).groupBy("zone").agg(*_measures(), F.sum("traps").alias("traps"))
    rows = zones.unionByName(status_counts(rollups, M.SUMMARY_MAPS), allowMissingColumns=True)
    zero = F.lit(0).cast("bigint")
    maps = [F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("dimension") == d, F.struct("name", "value"))))).alias(d)
            for d, _ in M.SUMMARY_MAPS]
    return rows.agg(
        F.count("zone").alias("zone_count"), F.coalesce(F.sum("n_aqi"), zero).alias("record_count"),
        _mean("aqi").alias("avg_aqi"), M.r1(F.max("max_aqi")).alias("max_aqi"), _mean("congestion_pct").alias("avg_congestion"),
        _mean("temperature_c").alias("avg_temperature"), F.coalesce(F.sum("traps"), zero).alias("pollution_trap_count"),
        F.coalesce(F.sum("closed"), zero).alias("road_closure_count"), store_time_text(F.max("newest")).alias("last_updated"), *maps)


def zone_analytics(rollups: DataFrame) -> DataFrame:
    """AG-05, AG-10 from rollup rows, zones A to Z."""
    return (_with_traps(rollups.filter("zone IS NOT NULL")).groupBy("zone").agg(
        F.sum("n").alias("record_count"), _mean("aqi").alias("avg_aqi"), M.r1(F.max("max_aqi")).alias("max_aqi"),
        _mean("congestion_pct").alias("avg_congestion"), M.r1(F.max("max_congestion_pct")).alias("max_congestion"),
        _mean("current_speed_kmph").alias("avg_speed"), _mean("temperature_c").alias("avg_temperature"),
        _mean("humidity_pct").alias("avg_humidity"), M.r1(F.coalesce(F.sum("sum_rainfall_mm"), F.lit(0.0))).alias("total_rainfall"),
        F.sum("traps").alias("pollution_trap_count"), F.sum("closed").alias("road_closure_count")).orderBy("zone"))


def trends(rollups: DataFrame) -> DataFrame:
    """AG-09 from rollup rows of the finest level (``range_rows(..., coarsest=0)``)."""
    return (_with_traps(rollups).groupBy("synchronized_time").agg(
        F.sum("n").alias("record_count"), _mean("aqi").alias("avg_aqi"), _mean("congestion_pct").alias("avg_congestion"),
        _mean("current_speed_kmph").alias("avg_speed"), _mean("temperature_c").alias("avg_temperature"),
        F.sum("traps").alias("pollution_trap_count")).orderBy("synchronized_time")
        .select(store_time_text("synchronized_time").alias("time"), "record_count", "avg_aqi", "avg_congestion", "avg_speed",
                "avg_temperature", "pollution_trap_count"))


# --- AG-03: distinct zones by sketches ----------------------------------------------------------

#: log2 of the sketch's registers: a relative standard error of about 1.04 / 2^(12 / 2) = 1.6 %.
SKETCH_LOG2 = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG2 / 2)
SKETCH_DDL = "synchronized_time timestamp_ntz, zones binary, norm_zones binary"


def sketch_rows(documents: DataFrame, bucket: str) -> DataFrame:
    """Per time bucket, a sketch of the zone texts and one of the normalised zones: a few KB each at most, however many zones
    there are. Sketches are built before the shuffle and merged after it."""
    rows = documents.select("zone", bucket_of("synchronized_time", bucket).alias("_start")).filter("zone IS NOT NULL")
    return rows.groupBy(F.col("_start").alias("start")).agg(
        F.hll_sketch_agg("zone", SKETCH_LOG2).alias("zones"),
        F.hll_sketch_agg(F.lower(F.trim("zone")), SKETCH_LOG2).alias("norm_zones")).withColumnRenamed("start", "synchronized_time")


def merged_sketches(sketches: DataFrame, bucket: str) -> DataFrame:
    """Sketch rows of a coarser bucket."""
    return (sketches.groupBy(bucket_of("synchronized_time", bucket).alias("start"))
            .agg(F.hll_union_agg("zones").alias("zones"), F.hll_union_agg("norm_zones").alias("norm_zones"))
            .withColumnRenamed("start", "synchronized_time"))


def distinct_zones(sketches: DataFrame) -> DataFrame:
    """AG-03, approximate: distinct zone texts and normalised zones of all these rows' documents, within ``SKETCH_ERROR`` as relative
    standard error. ``metrics.distinct_zones`` is the exact form."""
    def count(c: str) -> Column:
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0).cast("bigint"))
    return sketches.agg(count("zones").alias("zone_count"), count("norm_zones").alias("norm_zone_count"))
