"""Structured Streaming queries (STR-01..STR-07, SNK-01, SNK-02).

The unified stream keeps the newest reading of each feed per zone as keyed state in the
checkpoint (one streaming aggregation; no stream-stream join, no driver cache), and hands each
trigger's complete zones to an idempotent ``foreachBatch`` sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from zoneflow import schemas as S
from zoneflow.operators import latest as L
from zoneflow.operators import parse as P
from zoneflow.operators import unify as U
from zoneflow.functions.times import as_wall_clock
from zoneflow.sinks.documents import DocumentSink, checkpoint_writer
from zoneflow.sources.kafka import message_columns


def apply_trigger(writer: DataStreamWriter, kind: str = "availableNow",
                  processing_time: str = "30 seconds") -> DataStreamWriter:
    """STR-01: ``availableNow`` (default), ``once`` (run as availableNow: same single pass over
    what is available, without the deprecated form), or a processing-time interval."""
    k = kind.strip().lower()
    if k in ("availablenow", "available_now", "once"):
        return writer.trigger(availableNow=True)
    if k in ("processingtime", "processing_time"):
        return writer.trigger(processingTime=processing_time)
    raise ValueError(f"unknown trigger {kind!r}")


def latest_state(message_stream: DataFrame) -> DataFrame:
    """STR-04: newest reading per zone per feed; as a streaming aggregation its state is kept in
    the checkpoint, so a restart resumes with the zones already seen."""
    return L.latest_readings(message_columns(message_stream))


def processing_time() -> Column:
    """The trigger's processing time (one value per micro-batch) as local wall-clock
    ``timestamp_ntz`` in the documents' zone, whatever the session zone."""
    return as_wall_clock(F.current_timestamp())


def unified_batch_writer(sink: Callable[[DataFrame, int], None],
                         zones: DataFrame | None = None,
                         stamp: Callable[[int], Column] | None = None):
    """SNK-02 + STR-05: per trigger, turn the state rows into unified documents of complete zones
    and write them; no rows are collected."""
    def process(state: DataFrame, batch_id: int) -> None:
        sync = stamp(batch_id) if stamp else processing_time()
        # A trigger without a complete zone writes an empty batch (PRJ-08): if it is a replay, its
        # earlier documents go.
        sink(U.unified_from_state(state, sync, zones), batch_id)
    return process


def as_checkpoint_writer(sink, stream: DataFrame, checkpoint: str):
    """A document table as the writer that the checkpoint stands for; any other sink as it is."""
    return sink.as_writer(checkpoint_writer(stream.sparkSession, checkpoint)) if isinstance(sink, DocumentSink) else sink


def start_unified_stream(message_stream: DataFrame, sink: Callable[[DataFrame, int], None],
                         checkpoint: str, trigger: str = "availableNow",
                         processing_time_interval: str = "30 seconds",
                         output_mode: str = "complete", zones: DataFrame | None = None,
                         stamp: Callable[[int], Column] | None = None,
                         query_name: str | None = None) -> StreamingQuery:
    """STR-06: messages -> keyed latest state -> complete zones -> rules -> idempotent sink.

    ``complete`` re-emits every complete zone each trigger (the source's behaviour); ``update``
    emits only zones whose state changed (use it when the zone population is large). A document table is
    written as the checkpoint's own writer, so another checkpoint never replaces its batches.
    """
    sink = as_checkpoint_writer(sink, message_stream, checkpoint)
    writer = (latest_state(message_stream).writeStream
              .outputMode(output_mode)
              .foreachBatch(unified_batch_writer(sink, zones, stamp))
              .option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    return apply_trigger(writer, trigger, processing_time_interval).start()


def reading_trends(messages: DataFrame, bucket: str = S.TREND_BUCKET,
                   watermark: str | None = None) -> DataFrame:
    """STR-07: per ``bucket`` of message time, message count and feed averages.

    Grouped by the ``window`` column itself (needed for append mode with a watermark);
    ``withWatermark`` needs a ``timestamp`` column, so the time is cast when a watermark is set.
    """
    parsed = P.parse_all(message_columns(messages))
    t = F.col("kafka_time")
    if watermark:
        parsed = parsed.withColumn("kafka_time", t.cast("timestamp")).withWatermark(
            "kafka_time", watermark)
    closed = F.col("traffic_reading.road_closure") == F.lit(True)
    return (parsed.groupBy(F.window("kafka_time", bucket).alias("w")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.round(F.avg("aqi_reading.aqi"), 1).alias("avg_aqi"),
        F.round(F.avg("traffic_reading.congestion_pct"), 1).alias("avg_congestion"),
        F.round(F.avg("traffic_reading.current_speed_kmph"), 1).alias("avg_speed"),
        F.round(F.avg("weather_reading.temperature_c"), 1).alias("avg_temperature"),
        F.count_if(closed).alias("road_closures"),
    ).select(F.col("w.start").cast("timestamp_ntz").alias("time"), "messages", "avg_aqi",
             "avg_congestion", "avg_speed", "avg_temperature", "road_closures"))


def start_reject_stream(message_stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                        trigger: str = "availableNow", processing_time_interval: str = "30 seconds") -> StreamingQuery:
    """SNK-06: the messages that the other streams can't use, with their reason and raw payload, as a
    table (``sinks.documents.RejectSink``). Stateless."""
    writer = (P.rejected_messages(message_columns(message_stream)).writeStream.outputMode("append")
              .foreachBatch(sink).option("checkpointLocation", checkpoint))
    return apply_trigger(writer, trigger, processing_time_interval).start()


def start_console(stream: DataFrame, trigger: str = "processingTime",
                  processing_time_interval: str = "20 seconds") -> StreamingQuery:
    """SNK-01: append-mode console sink (debugging)."""
    writer = stream.writeStream.outputMode("append").format("console")
    return apply_trigger(writer, trigger, processing_time_interval).start()


def start_table_stream(stream: DataFrame, path: str, checkpoint: str,
                       output_mode: str = "append", trigger: str = "availableNow") -> StreamingQuery:
    """Write a stream to a Parquet table: the file sink for append mode (what unbounded streams
    should use), and an overwrite per trigger (``foreachBatch``) for complete results."""
    if output_mode == "append":
        writer = (stream.writeStream.format("parquet").option("path", path)
                  .option("checkpointLocation", checkpoint).outputMode("append"))
    else:
        def overwrite(df: DataFrame, batch_id: int) -> None:
            df.write.mode("overwrite").parquet(path)
        writer = (stream.writeStream.outputMode(output_mode).foreachBatch(overwrite)
                  .option("checkpointLocation", checkpoint))
    return apply_trigger(writer, trigger).start()
