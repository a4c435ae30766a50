"""Streams whose state or result outlives the simple forms of ``streams``: state that ends, late rows that count, repeats that don't.

* ``expiring_latest`` (STR-04): the latest readings per zone as keyed state that a zone leaves when it falls silent.
* ``TrendTable`` (STR-07): trends as mergeable partial aggregates, with the rows that came too late for an append stream kept
  aside and merged as corrections.
* ``deduplicated`` (SRC-01): messages that a producer sent again are dropped, with state for the time in which it may.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from zoneflow import schemas as S
from zoneflow.functions.times import tick_length
from zoneflow.operators import latest as L
from zoneflow.operators import parse as P
from zoneflow.session import child_names, path_exists, remove_path
from zoneflow.sinks.documents import with_retries
from zoneflow.sources.kafka import message_columns
from zoneflow.streaming import streams as ST

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def event_time(time: str = "kafka_time") -> Column:
    """The wall-clock time as the ``timestamp`` that watermarks need."""
    return F.col(time).cast("timestamp")


# --- state that ends ----------------------------------------------------------------------------

_FIELDS = ("payload string", "micros bigint", "kafka_partition int", "kafka_offset bigint")
_NEWEST = ", ".join(f"{S.FEED_PREFIX[t]}_{f}" for t in S.TOPICS for f in _FIELDS)
_NO_PARTITION, _NO_OFFSET = -(2**31), -(2**63)  # stand for null, which comes first in Spark's order
STATE_BUCKETS = 4096


def _merge_newest(ttl_micros: int) -> Callable:
    """Merges the messages of one bucket of zones into its state: a JSON object of the zones' newest message (payload, micros,
    partition, offset) of each feed. A call costs milliseconds, so it takes many zones; a message costs a step of a plain loop."""
    columns = ["norm_zone", "topic", "json_payload", "micros", "kafka_partition", "kafka_offset"]
    out_columns = ["norm_zone", *[f.split()[0] for f in _NEWEST.split(", ")]]
    place, nothing = {t: i for i, t in enumerate(S.TOPICS)}, (None,) * len(_FIELDS)

    def expiry(newest: list) -> int:
        return (max(n[1] for n in newest if n) + ttl_micros) // 1000

    def merge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        zones = json.loads(state.get[0]) if state.exists else {}
        touched = {}
        for batch in batches if not state.hasTimedOut else ():
            for zone, topic, *message in zip(*(batch[c].tolist() for c in columns), strict=True):
                newest = touched[zone] = zones.setdefault(zone, [None] * len(S.TOPICS))
                old = newest[place[topic]]
                if old is None or message[1:] > old[1:]:
                    newest[place[topic]] = message
        for newest in touched.values():
            oldest = max(n[1] for n in newest if n) - ttl_micros
            newest[:] = [n if n and n[1] >= oldest else None for n in newest]
        watermark = state.getCurrentWatermarkMs()
        ends = {zone: expiry(newest) for zone, newest in zones.items()}
        alive = {zone: newest for zone, newest in zones.items() if ends[zone] + 1 >= watermark}
        if alive:
            state.update((json.dumps(alive, ensure_ascii=False, separators=(",", ":")),))
            state.setTimeoutTimestamp(max(min(ends[zone] for zone in alive), watermark) + 1)
        else:
            state.remove()
        if touched:
            yield pd.DataFrame([[zone, *[x for n in newest for x in n or nothing]] for zone, newest in touched.items()],
                               columns=out_columns, dtype=object)

    return merge


def expiring_latest(message_stream: DataFrame, ttl: str, delay: str, buckets: int = STATE_BUCKETS) -> DataFrame:
    """STR-04 with an end: per zone and trigger with messages, the newest reading of each feed (``<feed>_reading``, as
    ``latest.latest_readings`` gives them), but none that is more than ``ttl`` (such as ``2 days``) older than the zone's
    newest message. Runs in update mode.

    A zone's state goes when the watermark (``delay`` behind the newest message of all) is ``ttl`` past its newest message, so the
    state holds the zones that are alive, however many there ever were. A zone that returns begins anew; as older readings would not
    count any more, the rows are the same whenever the state is dropped. Messages behind the watermark are dropped.

    Zones share state rows by a hash into ``buckets``, so a trigger makes at most so many calls of the merge function, however many
    zones it has; a bucket's state row holds its live zones. A checkpoint keeps the ``buckets`` that it began with.
    """
    micros = F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, kafka_time)")
    keyed = (message_columns(message_stream).withColumn("norm_zone", P.zone_of_payload())
             .filter(L.has_zone() & F.col("topic").isin(*S.TOPICS) & F.col("kafka_time").isNotNull())
             .select(F.pmod(F.xxhash64("norm_zone"), F.lit(buckets)).alias("bucket"), "norm_zone", "topic", "json_payload",
                     micros.alias("micros"), F.coalesce("kafka_partition", F.lit(_NO_PARTITION)).alias("kafka_partition"),
                     F.coalesce("kafka_offset", F.lit(_NO_OFFSET)).alias("kafka_offset"),
                     event_time().alias("event_time")).withWatermark("event_time", delay))
    seconds = int(tick_length(ttl) / dt.timedelta(seconds=1))
    rows = keyed.groupBy("bucket").applyInPandasWithState(
        _merge_newest(seconds * 1_000_000), f"norm_zone string, {_NEWEST}", "zones string", "update", GroupStateTimeout.EventTimeTimeout)
    raw = []
    for t in S.TOPICS:
        p = S.FEED_PREFIX[t]
        message = F.struct(F.col(f"{p}_payload").alias("json_payload"),
                           F.expr(f"timestampadd(MICROSECOND, {p}_micros, {_EPOCH})").alias("kafka_time"),
                           F.nullif(f"{p}_kafka_partition", F.lit(_NO_PARTITION)).alias("kafka_partition"),
                           F.nullif(f"{p}_kafka_offset", F.lit(_NO_OFFSET)).alias("kafka_offset"))
        raw.append(F.when(F.col(f"{p}_micros").isNotNull(), message).alias(f"_raw_{p}"))
    return P.parse_newest(rows.select("norm_zone", *raw), ("norm_zone",))


def start_expiring_unified(message_stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, ttl: str, delay: str,
                           trigger: str = "availableNow", processing_time_interval: str = "30 seconds",
                           zones: DataFrame | None = None, stamp: Callable[[int], Column] | None = None) -> StreamingQuery:
    """STR-06 on state that ends: each trigger writes the documents of the complete zones that had messages."""
    sink = ST.as_checkpoint_writer(sink, message_stream, checkpoint)
    writer = (expiring_latest(message_stream, ttl, delay).writeStream.outputMode("update")
              .foreachBatch(ST.unified_batch_writer(sink, zones, stamp)).option("checkpointLocation", checkpoint))
    return ST.apply_trigger(writer, trigger, processing_time_interval).start()


# --- late rows that count -----------------------------------------------------------------------

_AVERAGES = {"avg_aqi": "aqi_reading.aqi", "avg_congestion": "traffic_reading.congestion_pct",
             "avg_speed": "traffic_reading.current_speed_kmph", "avg_temperature": "weather_reading.temperature_c"}
PARTIAL_DDL = ("time timestamp_ntz, late boolean, messages bigint, road_closures bigint, newest timestamp_ntz, "
               + ", ".join(f"n_{a} bigint, sum_{a} double" for a in _AVERAGES))
LATE_DDL = "topic string, json_payload string, kafka_time timestamp_ntz, kafka_partition int, kafka_offset bigint"


class TrendTable:
    """STR-07 with corrections: trends per ``bucket`` of message time, at ``path``; a ``foreachBatch`` sink of messages.

    Each batch leaves one partial aggregate a bucket, marked late where an append stream with this ``delay`` would have dropped its
    rows (the bucket had ended ``delay`` before the newest message of earlier batches), and the late rows themselves.
    Partials merge, so a correction costs the late rows alone; no state is held for buckets that might still be corrected. A replayed
    batch replaces what it had left.
    """

    def __init__(self, path: str, bucket: str = S.TREND_BUCKET, delay: str = "1 minute"):
        self.path, self.bucket, self.delay = path.rstrip("/"), bucket, delay

    def _parts(self, spark: SparkSession, root: str) -> dict[int, str]:
        """Complete folders by their (last) batch."""
        names = {int(n.split("=")[1]): f"{self.path}/{root}/{n}" for n in child_names(spark, f"{self.path}/{root}") if "=" in n}
        return {b: f for b, f in names.items() if path_exists(spark, f"{f}/_SUCCESS")}

    def _partials(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The partials of all batches (or of those ``before`` one)."""
        folded = {b: f for b, f in self._parts(spark, "folded").items() if before is None or b < before}
        upto = max(folded, default=-1)
        folders = [f for b, f in self._parts(spark, "partials").items() if b > upto and (before is None or b < before)]
        folders += [folded[upto]] if folded else []
        return spark.read.schema(PARTIAL_DDL).parquet(*folders) if folders else spark.createDataFrame([], PARTIAL_DDL)

    def _horizon(self, partials: DataFrame) -> Column | None:
        """What a watermark would be after these partials: one value."""
        newest = partials.agg(F.max("newest")).first()[0]
        return None if newest is None else F.lit(newest.isoformat(" ")).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.delay}")

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        horizon = self._horizon(self._partials(spark, batch_id))
        end = F.window("kafka_time", self.bucket).end
        rows = message_columns(messages).filter("kafka_time IS NOT NULL").withColumn("_end", end)
        rows = rows.withColumn("_late", F.lit(False) if horizon is None else F.col("_end") <= horizon).persist()
        try:
            parsed = P.parse_all(rows)
            late = F.lit(False) if horizon is None else F.col("w.end") <= horizon
            values = [f(F.col(c).cast("double")).alias(f"{n}_{a}") for a, c in _AVERAGES.items() for n, f in (("n", F.count), ("sum", F.sum))]
            partial = (parsed.groupBy(F.window("kafka_time", self.bucket).alias("w")).agg(
                F.count(F.lit(1)).alias("messages"), F.count_if(F.col("traffic_reading.road_closure") == F.lit(True)).alias("road_closures"),
                F.max("kafka_time").alias("newest"), *values)
                .select(F.col("w.start").alias("time"), late.alias("late"), "messages", "road_closures", "newest",
                        *[f"{n}_{a}" for a in _AVERAGES for n in ("n", "sum")]))
            name = f"batch_id={int(batch_id)}"
            aside = rows.filter("_late").select("topic", "json_payload", *P.KAFKA_COLS)
            with_retries(lambda _: aside.write.mode("overwrite").parquet(f"{self.path}/late/{name}"))
            with_retries(lambda _: partial.write.mode("overwrite").parquet(f"{self.path}/partials/{name}"))
        finally:
            rows.unpersist()

    def read(self, spark: SparkSession, corrected: bool = True) -> DataFrame:
        """The closed buckets: time, messages, the four averages, road_closures and late_messages; without corrections as an
        append stream would have left them."""
        partials = self._partials(spark)
        horizon = self._horizon(partials)
        if horizon is not None:
            partials = partials.filter(F.col("time") + F.expr(f"INTERVAL {self.bucket}") <= horizon)
        if not corrected:
            partials = partials.filter("NOT late")
        means = [F.round(F.sum(f"sum_{a}") / F.nullif(F.sum(f"n_{a}"), F.lit(0)), 1).alias(a) for a in _AVERAGES]
        return partials.groupBy("time").agg(
            F.sum("messages").alias("messages"), *means, F.sum("road_closures").alias("road_closures"),
            F.coalesce(F.sum(F.when(F.col("late"), F.col("messages"))), F.lit(0).cast("bigint")).alias("late_messages"))

    def late_rows(self, spark: SparkSession) -> DataFrame:
        """The messages that came late, as they were."""
        folders = list(self._parts(spark, "late").values())
        return spark.read.schema(LATE_DDL).parquet(*folders) if folders else spark.createDataFrame([], LATE_DDL)

    def fold(self, spark: SparkSession, upto: int) -> None:
        """Merge the partials of the batches up to ``upto`` (closed ones) into one folder. It counts once it is complete."""
        partials = self._partials(spark, upto + 1)
        sums = [c.split()[0] for c in PARTIAL_DDL.split(", ") if c.split()[0] not in ("time", "late", "newest")]
        merged = partials.groupBy("time", "late").agg(F.max("newest").alias("newest"), *[F.sum(c).alias(c) for c in sums])
        target = f"{self.path}/folded/upto={int(upto)}"
        if path_exists(spark, f"{target}/_SUCCESS"):
            return
        names = [c.split()[0] for c in PARTIAL_DDL.split(", ")]
        with_retries(lambda _: merged.select(*names).write.mode("overwrite").parquet(target))
        for batch, folder in self._parts(spark, "partials").items():
            if batch <= upto:
                remove_path(spark, folder)
        for batch, folder in self._parts(spark, "folded").items():
            if batch < upto:
                remove_path(spark, folder)


def start_corrected_trends(message_stream: DataFrame, table: TrendTable, checkpoint: str, trigger: str = "availableNow",
                           processing_time_interval: str = "30 seconds") -> StreamingQuery:
    """STR-07 with corrections: a stateless stream into a ``TrendTable``."""
    writer = message_stream.writeStream.foreachBatch(table).option("checkpointLocation", checkpoint)
    return ST.apply_trigger(writer, trigger, processing_time_interval).start()


# --- repeats that don't count -------------------------------------------------------------------

def deduplicated(message_stream: DataFrame, delay: str, by_content: bool = True) -> DataFrame:
    """SRC-01: message columns without repeats. Producers deliver at least once, and a sent-again message has an offset of its own, so
    what is compared is topic and payload (``by_content``); without it topic, partition and offset, for sources that read a
    message twice. A repeat is dropped if it comes within ``delay`` of message time; state is held that long."""
    keys = {"_payload": F.unhex(F.sha2("json_payload", 256))} if by_content else {}
    rows = message_columns(message_stream).withColumns({"_event_time": event_time(), **keys}).withWatermark("_event_time", delay)
    names = ["topic", "_payload"] if by_content else ["topic", "kafka_partition", "kafka_offset"]
    return rows.dropDuplicatesWithinWatermark(names).drop("_event_time", *keys)
