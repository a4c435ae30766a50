"""Streaming behaviour: batch = stream, restart from the checkpoint, replayed batches,
"""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from zoneflow import schemas as S
from zoneflow.functions.times import ntz
from zoneflow.operators import unify as U
from zoneflow.plans import catalog as C
from zoneflow.sinks.documents import DocumentSink
from zoneflow.sinks.publish import write_message_files
from zoneflow.plans import fixtures
from zoneflow.sources.kafka import message_columns
from zoneflow.streaming import streams as ST

AS_OF = dt.datetime(2024, 1, 31)


def _msg(spark, rows):
    """Kafka-shaped messages from (topic, payload dict, time, offset) tuples."""
    data = [(None, bytearray(json.dumps(p).encode()), t, 0, off, ts, 0)
            for t, p, ts, off in rows]
    return spark.createDataFrame(data, S.MESSAGE_SCHEMA)


def _aqi(zone, aqi):
    return {"sensor_id": "A", "zone": zone, "aqi": aqi}


def _traffic(zone, cong, closed=False):
    return {"sensor_id": "T", "zone": zone, "congestion_pct": cong, "road_closure": closed}


def _weather(zone, rain):
    return {"sensor_id": "W", "zone": zone, "rainfall_mm": rain}


def _run(spark, src, base, sink):
    q = ST.start_unified_stream(fixtures.read_message_files_stream(spark, src), sink,
                                os.path.join(base, "ckpt"), stamp=lambda b: ntz(AS_OF))
    q.awaitTermination()


def test_batch_equals_stream(spark, scratch):
    sf = "/root/testdata/sf0.001"
    sink = DocumentSink(os.path.join(scratch, "docs"))
    q = ST.start_unified_stream(fixtures.read_message_stream(spark, sf), sink,
                                os.path.join(scratch, "ckpt"), stamp=lambda b: ntz(AS_OF))
    q.awaitTermination()
    streamed = sorted(map(tuple, sink.read(spark).select(*S.UNIFIED_COLUMNS).collect()))
    batch = sorted(map(tuple, C.QUERIES["unified_snapshot"](spark, sf).collect()))
    assert streamed == batch and len(batch) == 5


def test_restart_keeps_state(spark, scratch):
    src = os.path.join(scratch, "topic")
    sink = DocumentSink(os.path.join(scratch, "docs"))
    t0 = dt.datetime(2024, 1, 1, 10)
    write_message_files(_msg(spark, [
        (S.AQI_TOPIC, _aqi("Kothrud", 250), t0, 1),
        (S.TRAFFIC_TOPIC, _traffic("Kothrud", 70.0), t0, 2)]), src)
    _run(spark, src, scratch, sink)
    assert os.path.exists(sink.path) is False or sink.read_all(spark).count() == 0
    # second run: only the missing feed arrives; the zone completes from checkpointed state
    write_message_files(_msg(spark, [(S.WEATHER_TOPIC, _weather(" KOTHRUD ", 1.0), t0, 3)]), src)
    _run(spark, src, scratch, sink)
    docs = sink.read(spark).collect()
    assert len(docs) == 1
    assert docs[0]["zone"] == "Kothrud" and docs[0]["city_alert"] == S.ALERT_POLLUTION_TRAP


def test_out_of_order_does_not_replace_newer(spark, scratch):
    src = os.path.join(scratch, "topic")
    sink = DocumentSink(os.path.join(scratch, "docs"))
    t = dt.datetime(2024, 1, 1, 12)
    write_message_files(_msg(spark, [
        (S.AQI_TOPIC, _aqi("Hadapsar", 150), t, 10),
        (S.TRAFFIC_TOPIC, _traffic("Hadapsar", 10.0), t, 11),
        (S.WEATHER_TOPIC, _weather("Hadapsar", 0.0), t, 12)]), src)
    _run(spark, src, scratch, sink)
    # a later batch brings an older AQI reading: the newer one stays
    write_message_files(_msg(spark, [(S.AQI_TOPIC, _aqi("Hadapsar", 350),
                                      t - dt.timedelta(hours=1), 13)]), src)
    _run(spark, src, scratch, sink)
    batches = sink.read_all(spark).orderBy("batch_id").select("batch_id", "aqi").collect()
    assert [r["aqi"] for r in batches] == [150, 150]


def test_replayed_batch_is_idempotent(spark, scratch):
    sink = DocumentSink(os.path.join(scratch, "docs"))
    mc = message_columns(fixtures.read_messages(spark, "/root/testdata/sf0.001"))
    docs = U.unified_snapshot(mc, AS_OF)
    sink.write(docs, 0)
    first = sorted(map(tuple, sink.read_all(spark).collect()))
    sink.write(docs, 0)  # the same batch again, as after a restart
    assert sorted(map(tuple, sink.read_all(spark).collect())) == first
    sink.write(docs.withColumn("aqi", F.lit(1)), 1)  # a newer batch wins per key
    assert {r["aqi"] for r in sink.read(spark).collect()} == {1}


def test_replay_across_midnight_replaces_the_whole_batch(spark, scratch):
    sink = DocumentSink(os.path.join(scratch, "docs"))
    mc = message_columns(fixtures.read_messages(spark, "/root/testdata/sf0.001"))
    sink.write(U.unified_snapshot(mc, dt.datetime(2024, 1, 30, 23, 59, 59)), 7)
    sink.write(U.unified_snapshot(mc, dt.datetime(2024, 1, 31, 0, 0, 1)), 7)
    docs = sink.read_all(spark).collect()
    assert len(docs) == 5 and {r.synchronized_time for r in docs} == {dt.datetime(2024, 1, 31, 0, 0, 1)}
    sink.write(U.unified_snapshot(mc.limit(0), AS_OF), 7)  # replayed again, without a complete zone
    assert sink.read_all(spark).count() == sink.read(spark).count() == 0


def test_missing_table_is_empty(spark, scratch):
    from zoneflow.operators import metrics as M
    docs = DocumentSink(os.path.join(scratch, "none")).read(spark, keep_date=True)
    assert docs.count() == 0 and M.latest_documents(docs, AS_OF).count() == 0
    assert M.summary(docs, AS_OF).first().zone_count == 0


def test_compaction_keeps_the_documents(spark, scratch):
    sink = DocumentSink(os.path.join(scratch, "docs"))
    mc = message_columns(fixtures.read_messages(spark, "/root/testdata/sf0.001"))
    for batch in range(6):  # batches 4 and 5 write the documents of 2 and 3 again
        at = AS_OF + dt.timedelta(hours=batch % 4 * 20)
        sink.write(U.unified_snapshot(mc, at).withColumn("aqi", F.lit(batch)), batch)
    before = sorted(map(tuple, sink.read(spark).collect()))
    for upto, folders in ((2, 3), (4, 1), (5, 0)):
        sink.compact(spark, upto)
        assert sorted(map(tuple, sink.read(spark).collect())) == before and len(before) == 20
        assert len([n for n in os.listdir(os.path.join(sink.path, "batches")) if n.startswith("batch_id=")]) == folders
        assert os.listdir(os.path.join(sink.path, "compacted")) == [f"batch_id={upto}"]
    sink.write(U.unified_snapshot(mc, AS_OF).withColumn("aqi", F.lit(99)), 6)
    assert {r.aqi for r in sink.read(spark).collect() if r.synchronized_time == AS_OF} == {99}


def test_scheduled_batch_runs_over_overlapping_ranges(spark, scratch):
    import pytest

    from zoneflow.sinks.documents import RejectSink
    sink, rejects = DocumentSink(os.path.join(scratch, "docs")), RejectSink(os.path.join(scratch, "rejects"))
    t = dt.datetime(2024, 1, 1, 12)
    mc = message_columns(_msg(spark, [
        (S.AQI_TOPIC, _aqi("Kothrud", 150), t, 1), (S.TRAFFIC_TOPIC, _traffic("Kothrud", 10.0), t, 2),
        (S.WEATHER_TOPIC, _weather("Kothrud", 0.0), t, 3), (S.AQI_TOPIC, _aqi(None, 1), t, 4),
        (S.AQI_TOPIC, _aqi("Kothrud", 310), t + dt.timedelta(minutes=20), 5)]))
    for run, minutes in enumerate((10, 25, 25)):  # the last run again
        U.scheduled_batch(mc, t + dt.timedelta(minutes=minutes), 30, sink, min(run, 1), rejects)
    docs = sorted((r.synchronized_time.minute, r.aqi) for r in sink.read(spark).collect())
    assert docs == [(10, 150), (25, 310)]
    assert [(r.reject_reason, r.kafka_offset) for r in rejects.read(spark).collect()] == [("missing_zone", 4)] * 2
    with pytest.raises(U.NothingComplete):
        U.scheduled_batch(mc, t + dt.timedelta(hours=5), 30, sink, 2, rejects)
    assert sink.read(spark).count() == 2


def test_reject_stream_keeps_the_raw_payload(spark, scratch):
    from zoneflow.operators.parse import valid_messages
    from zoneflow.sinks.documents import RejectSink
    src, sink = os.path.join(scratch, "topic"), RejectSink(os.path.join(scratch, "rejects"))
    t0 = dt.datetime(2024, 1, 1)
    assert sink.read(spark).count() == 0
    messages = _msg(spark, [(S.AQI_TOPIC, _aqi("Kothrud", 1), t0, 1), ("other", {"a": 1}, t0, 2), (S.AQI_TOPIC, ["x"], t0, 3)])
    write_message_files(messages, src)
    ST.start_reject_stream(fixtures.read_message_files_stream(spark, src), sink, os.path.join(scratch, "ckpt")).awaitTermination()
    got = {r.kafka_offset: (r.reject_reason, r.json_payload) for r in sink.read(spark).collect()}
    assert got.keys() == {2, 3} and got[2] == ("unknown_topic", '{"a": 1}') and got[3][1] == '["x"]'
    assert valid_messages(message_columns(messages)).count() == 1


def test_trigger_choice():
    class W:
        def trigger(self, **kw):
            return kw
    assert ST.apply_trigger(W(), "once") == {"availableNow": True}
    assert ST.apply_trigger(W(), "availableNow") == {"availableNow": True}
    assert ST.apply_trigger(W(), "processingTime", "20 seconds") == {"processingTime": "20 seconds"}
