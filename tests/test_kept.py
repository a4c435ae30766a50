"""State kept between runs: carry-in tables, rollups and sketches, writers and compaction of the document table, expiring
stream state, late corrections, offset ledger, repeat-safe publishing."""

import datetime as dt
import json
import os
import random
import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from zoneflow import schemas as S
from zoneflow.functions.times import ntz
from zoneflow.operators import history as H
from zoneflow.operators import metrics as M
from zoneflow.operators import rollups as R
from zoneflow.operators import unify as U
from zoneflow.plans import catalog as C
from zoneflow.plans import fixtures
from zoneflow.plans.params import AS_OF, RANGE_LONG, TICK
from zoneflow.sinks.carry import CarryTable
from zoneflow.sinks.documents import DocumentSink, checkpoint_writer
from zoneflow.sinks.publish import batch_messages, distinct_messages, write_message_files
from zoneflow.sources.kafka import message_columns, within_offsets
from zoneflow.sources.ledger import OffsetLedger, ledger_batch
from zoneflow.streaming import kept as KS
from zoneflow.streaming import streams as ST

T0 = dt.datetime(2024, 1, 10, 12)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def msg(spark, rows):
    """Kafka-shaped messages from (topic, payload dict, time, offset) tuples."""
    data = [(None, bytearray(json.dumps(p).encode()), t, 0, off, ts, 0) for t, p, ts, off in rows]
    return spark.createDataFrame(data, S.MESSAGE_SCHEMA)


def readings(zone, at, offset, aqi=100):
    """One message of each feed."""
    return [(S.AQI_TOPIC, {"zone": zone, "aqi": aqi}, at, offset), (S.TRAFFIC_TOPIC, {"zone": zone, "congestion_pct": 10.0}, at, offset + 1),
            (S.WEATHER_TOPIC, {"zone": zone, "rainfall_mm": 0.0}, at, offset + 2)]


def executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- carry-in tables ----------------------------------------------------------------------------

def test_carried_replay_equals_the_whole_one(spark, scratch):
    mc, table = C.message_cols(spark, SF_SMALL), CarryTable(os.path.join(scratch, "carry"))
    since = AS_OF - dt.timedelta(minutes=RANGE_LONG)
    whole = rows_of(H.replay_history(mc, AS_OF, TICK).filter(F.col("synchronized_time") >= ntz(since)))
    assert rows_of(H.replay_history(mc, AS_OF, TICK, since=since, carry=table)) == whole  # nothing kept yet
    for days in (25, 12, 12, 3):  # one boundary twice
        table.extend(mc, AS_OF - dt.timedelta(days=days))
    assert len(table.boundaries(spark)) == 3
    assert rows_of(H.replay_history(mc, AS_OF, TICK, since=since, carry=table)) == whole
    table.extend(mc, AS_OF - dt.timedelta(minutes=RANGE_LONG // 2))  # too new for this range
    assert rows_of(H.replay_history(mc, AS_OF, TICK, since=since, carry=table)) == whole
    with pytest.raises(ValueError):
        H.replay_history(mc, AS_OF, TICK, carry=table)


def test_carried_replay_reads_no_message_before_its_boundary(spark, scratch):
    """The scans have a lower time bound: of the replay, and of an extension."""
    mc, table = C.message_cols(spark, SF_SMALL), CarryTable(os.path.join(scratch, "carry"))
    table.extend(mc, AS_OF - dt.timedelta(days=2))
    since = AS_OF - dt.timedelta(minutes=RANGE_LONG)
    plan = executed_plan(table.messages_since(mc, since - dt.timedelta(hours=1)))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,2024-01-29T00:00", plan), plan


def test_extension_reads_the_new_messages_alone(spark, scratch):
    table = CarryTable(os.path.join(scratch, "carry"))
    old = message_columns(msg(spark, readings("Kothrud", T0, 1, 50)))
    table.extend(old, T0 + dt.timedelta(hours=1))
    new = message_columns(msg(spark, readings("Aundh", T0 + dt.timedelta(hours=2), 11)[:1]))  # the old ones are not there any more
    table.extend(new, T0 + dt.timedelta(hours=3))
    got = {(r.norm_zone, r.topic): r.kafka_offset for r in table.read(spark, T0 + dt.timedelta(hours=3)).collect()}
    assert got == {("kothrud", S.AQI_TOPIC): 1, ("kothrud", S.TRAFFIC_TOPIC): 2, ("kothrud", S.WEATHER_TOPIC): 3, ("aundh", S.AQI_TOPIC): 11}


def test_late_messages_amend_later_boundaries(spark, scratch):
    table, hour = CarryTable(os.path.join(scratch, "carry")), dt.timedelta(hours=1)
    mc = message_columns(msg(spark, readings("Kothrud", T0, 1)))
    for h in (1, 2, 3):
        table.extend(mc, T0 + h * hour)
    late = message_columns(msg(spark, [(S.AQI_TOPIC, {"zone": "Kothrud", "aqi": 7}, T0 + 1.5 * hour, 9)]))
    table.amend(late)
    table.amend(late.limit(0))
    newest = {h: {r.topic: r.kafka_offset for r in table.read(spark, T0 + h * hour).collect()}[S.AQI_TOPIC] for h in (1, 2, 3)}
    assert newest == {1: 1, 2: 9, 3: 9}
    table.forget_before(spark, T0 + 2 * hour)
    assert table.boundaries(spark) == [T0 + 2 * hour, T0 + 3 * hour]
    assert table.read(spark, T0 + 2 * hour).count() == 3


# --- rollups and sketches -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    C.history(spark, SF_SMALL).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


RANGES = [(AS_OF, 60), (AS_OF, 1440), (AS_OF - dt.timedelta(minutes=17, seconds=3), 1003), (AS_OF - dt.timedelta(seconds=1), 1),
          (AS_OF + dt.timedelta(days=40), 60)]


def test_rollups_answer_as_the_documents_do(spark, scratch, documents):
    sink, table = DocumentSink(os.path.join(scratch, "docs")), R.RollupTable(os.path.join(scratch, "rollups"))
    write, time = R.kept_up(sink, table), F.col("synchronized_time")
    recent = documents.filter(time > ntz(AS_OF - dt.timedelta(days=2)))
    # times inside buckets, documents without a zone, and corrections of what was written before
    moved = recent.withColumn("synchronized_time", time + F.expr("make_interval(0, 0, 0, 0, 0, 0, pmod(hash(zone), 1700))"))
    odd = moved.filter("zone = 'Kothrud'").withColumn("zone", F.lit(None).cast("string"))
    write(recent.withColumn("aqi", F.lit(9999)), 0)
    write(recent.unionByName(moved).unionByName(odd), 1)
    write(recent.limit(0), 2)
    docs = sink.read(spark, keep_date=True).cache()
    for as_of, minutes in RANGES:
        rolled = table.range_rows(spark, sink, as_of, minutes).cache()
        assert rows_of(R.summary(rolled)) == rows_of(M.summary(docs, as_of, minutes))
        assert rows_of(R.zone_analytics(rolled)) == rows_of(M.zone_analytics(docs, as_of, minutes))
        assert rows_of(R.status_breakdown(rolled)) == rows_of(M.status_breakdown(docs, as_of, minutes))
        fine = table.range_rows(spark, sink, as_of, minutes, coarsest=0)
        assert rows_of(R.trends(fine)) == rows_of(M.trends(docs, as_of, minutes))
        rolled.unpersist()
    table.compact(spark, 1)
    assert rows_of(R.summary(table.range_rows(spark, sink, *RANGES[2]))) == rows_of(M.summary(docs, *RANGES[2]))
    docs.unpersist()


def test_a_range_reads_documents_at_its_ends_only(spark, scratch, documents):
    sink, table = DocumentSink(os.path.join(scratch, "docs")), R.RollupTable(os.path.join(scratch, "rollups"))
    R.kept_up(sink, table)(documents.filter(F.col("synchronized_time") > ntz(AS_OF - dt.timedelta(days=3))), 0)
    plan = executed_plan(table.range_rows(spark, sink, AS_OF - dt.timedelta(minutes=17, seconds=3), 1003))
    lines = plan.splitlines()
    filters = [above for above, scan in zip(lines, lines[1:]) if "FileScan" in scan and "/docs/batches" in scan]
    bounds = sorted(tuple(re.findall(r"2024-01-3\d [\d:]+", f)) for f in filters)
    # the ragged half minutes at the start and at the end
    assert bounds == [("2024-01-30 06:59:57", "2024-01-30 07:00:00"), ("2024-01-30 23:42:30", "2024-01-30 23:42:57")], plan


def test_sketches_merge_and_stay_within_their_error(spark, scratch, documents):
    many = documents.limit(1).crossJoin(spark.range(30_000).select(F.concat(F.lit(" Zone "), "id", F.lit(" ")).alias("name"), F.col("id").alias("i")))
    many = many.withColumn("zone", F.col("name")).withColumn("synchronized_time", ntz(AS_OF) - F.expr("make_interval(0, 0, 0, 0, 0, i % 1400, 0)"))
    docs = many.drop("name", "i").unionByName(documents.limit(1).withColumn("zone", F.lit("zone 7")).withColumn("synchronized_time", ntz(AS_OF)))
    sink, table = DocumentSink(os.path.join(scratch, "docs")), R.SketchTable(os.path.join(scratch, "sketches"), ("1 hour", "4 hours"))
    R.kept_up(sink, table)(docs, 0)
    got = R.distinct_zones(table.range_rows(spark, sink, AS_OF, 1440)).first()
    exact = M.distinct_zones(sink.read(spark, keep_date=True), AS_OF, 1440).first()
    assert (exact.zone_count, exact.norm_zone_count) == (30_001, 30_000)
    for c in ("zone_count", "norm_zone_count"):
        assert abs(got[c] - exact[c]) <= 4 * R.SKETCH_ERROR * exact[c]
    assert R.distinct_zones(table.range_rows(spark, sink, AS_OF - dt.timedelta(days=90), 60)).first().zone_count == 0


def test_levels_divide_one_another(scratch):
    with pytest.raises(ValueError):
        R.RollupTable(scratch, ("45 seconds", "1 hour", "90 minutes"))


# --- writers and compaction ---------------------------------------------------------------------

def unified(spark, zone, at, aqi):
    return U.unified_snapshot(message_columns(msg(spark, readings(zone, at, 1, aqi))), at)


def kept(spark, sink):
    return {(r.zone, r.synchronized_time): r.aqi for r in sink.read(spark).collect()}


def test_writers_do_not_replace_each_others_batches(spark, scratch):
    stream = DocumentSink(os.path.join(scratch, "docs"), writer="stream")
    job, day = stream.as_writer("job"), dt.timedelta(days=1)
    stream.write(unified(spark, "Kothrud", T0, 1), 0)
    job.write(unified(spark, "Aundh", T0 + day, 2), 0)
    both = {("Kothrud", T0): 1, ("Aundh", T0 + day): 2}
    assert kept(spark, stream) == kept(spark, job) == both
    stream.compact(spark, 0)
    assert kept(spark, job) == both
    fresh = stream.as_writer("second-checkpoint")  # begins at 0 again
    fresh.write(unified(spark, "Wakad", T0, 3), 0)
    both["Wakad", T0] = 3
    assert kept(spark, stream) == both
    for writer in (job, fresh):
        writer.compact(spark, 0)
    assert kept(spark, stream) == both and not os.path.exists(os.path.join(scratch, "docs", "batches", "batch_id=0"))
    stream.write(unified(spark, "Baner", T0, 4), 0)  # a batch number that was folded before: a batch all the same
    assert kept(spark, stream) == both | {("Baner", T0): 4}


def test_the_last_written_version_counts_whoever_wrote_it(spark, scratch):
    one = DocumentSink(os.path.join(scratch, "docs"), writer="one")
    two = one.as_writer("two")
    one.write(unified(spark, "Kothrud", T0, 1), 5)
    two.write(unified(spark, "Kothrud", T0, 2), 0)
    assert kept(spark, one) == {("Kothrud", T0): 2}
    two.compact(spark, 0)
    assert kept(spark, one) == {("Kothrud", T0): 2}
    one.write(unified(spark, "Kothrud", T0, 3), 5)  # a replay keeps its place
    assert kept(spark, one) == {("Kothrud", T0): 2}
    one.compact(spark, 5)
    assert kept(spark, one) == {("Kothrud", T0): 2}


def test_a_lost_checkpoint_loses_no_documents(spark, scratch):
    src, sink = os.path.join(scratch, "topic"), DocumentSink(os.path.join(scratch, "docs"))
    write_message_files(msg(spark, readings("Kothrud", T0, 1, 1)), src)

    def run(checkpoint, at):
        ST.start_unified_stream(fixtures.read_message_files_stream(spark, src), sink, os.path.join(scratch, checkpoint),
                                stamp=lambda b: ntz(at)).awaitTermination()

    run("one", T0)
    run("one", T0)  # a restart: the same writer, nothing new
    run("two", T0 + dt.timedelta(days=1))  # the checkpoint is lost: batch 0 again
    assert kept(spark, sink) == {("Kothrud", T0): 1, ("Kothrud", T0 + dt.timedelta(days=1)): 1}
    one, two = (checkpoint_writer(spark, os.path.join(scratch, c)) for c in ("one", "two"))
    assert one != two and one == checkpoint_writer(spark, os.path.join(scratch, "one"))


def sizes(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_compaction_rewrites_the_touched_dates_only(spark, scratch):
    sink = DocumentSink(os.path.join(scratch, "docs"))
    for day in range(4):
        sink.write(unified(spark, "Kothrud", T0 + dt.timedelta(days=day), day), day)
    sink.compact(spark, 3)
    before = sizes(os.path.join(sink.path, "dates"))
    sink.write(unified(spark, "Aundh", T0 + dt.timedelta(days=3), 9), 4)
    sink.write(unified(spark, "Kothrud", T0 + dt.timedelta(days=4), 9), 5)
    want = kept(spark, sink)
    sink.compact(spark, 5)
    after = sizes(os.path.join(sink.path, "dates"))
    assert kept(spark, sink) == want and len(want) == 6
    same = {f for f in before if after.get(f) == before[f]}
    assert len(same) == 3 and {re.search(r"sync_date=([\d-]+)", f)[1] for f in set(after) - same} == {"2024-01-13", "2024-01-14"}


@pytest.mark.parametrize("step", ["rows", "list", "clean"])
def test_compaction_that_stops_loses_nothing(spark, scratch, monkeypatch, step):
    sink = DocumentSink(os.path.join(scratch, "docs"), attempts=1)
    for batch in range(3):
        sink.write(unified(spark, "Kothrud", T0 + dt.timedelta(days=batch % 2), batch), batch)
    sink.compact(spark, 0)
    want = kept(spark, sink)

    def stop(*a, **k):
        raise OSError("stopped")

    with monkeypatch.context() as m:
        if step == "rows":
            m.setattr("zoneflow.sinks.documents.latest_version", stop)
        elif step == "list":
            m.setattr(type(spark), "createDataFrame", stop)
        else:
            m.setattr(DocumentSink, "_clean", stop)
        with pytest.raises(OSError):
            sink.compact(spark, 2)
    assert kept(spark, sink) == want == {("Kothrud", T0): 2, ("Kothrud", T0 + dt.timedelta(days=1)): 1}
    sink.compact(spark, 2)
    sink.write(unified(spark, "Kothrud", T0, 7), 3)
    sink.compact(spark, 3)
    assert kept(spark, sink) == want | {("Kothrud", T0): 7}


def test_writer_names(scratch):
    with pytest.raises(ValueError):
        DocumentSink(scratch, writer="a/b")


def test_newest_documents_scan_the_newest_dates(spark, scratch, documents):
    sink = DocumentSink(os.path.join(scratch, "docs"))
    for batch in range(2):  # every document in two versions: dates are counted by documents, not by rows
        sink.write(documents, batch)
    for n in (1, 7, 200, 10_000):
        assert rows_of(sink.newest(spark, n)) == rows_of(M.newest(documents, n).select(*S.UNIFIED_COLUMNS))
    plan = executed_plan(sink.newest(spark, 7))
    dates = re.findall(r"sync_date#\d+ >= (\d{4}-\d\d-\d\d)", plan.split("PartitionFilters", 1)[1])
    assert dates and min(dates) >= "2024-01-29", plan


# --- state that ends ----------------------------------------------------------------------------

def feed(spark, base, rows, start):
    write_message_files(msg(spark, rows), os.path.join(base, "topic"))
    query = start(fixtures.read_message_files_stream(spark, os.path.join(base, "topic")), os.path.join(base, "ckpt"))
    query.awaitTermination()
    return query


def test_silent_zones_leave_the_state_and_may_return(spark, scratch):
    seen = []

    def start(stream, checkpoint):
        rows = KS.expiring_latest(stream, "2 hours", "10 minutes").select("norm_zone", "aqi_reading.aqi", "traffic_reading.congestion_pct")
        return ST.apply_trigger(rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(
            lambda batch, i: seen.extend(tuple(r) for r in batch.collect()))).start()

    def held(query):
        return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1]

    hour = dt.timedelta(hours=1)
    first = [m for i in range(20) for m in readings(f"Zone {i}", T0, 10 * i)]
    assert held(feed(spark, scratch, first, start)) == 20 and len(seen) == 20
    feed(spark, scratch, readings("Zone 0", T0 + 5 * hour, 500), start)
    last = feed(spark, scratch, readings("Zone 0", T0 + 6 * hour, 510, 70), start)
    assert held(last) == 1  # the other nineteen fell silent
    assert seen[-1] == ("zone 0", 70, 10.0)
    feed(spark, scratch, readings("Zone 3", T0 + 6 * hour, 520, 30)[:1], start)
    assert seen[-1] == ("zone 3", 30, None)  # it begins anew: the traffic reading of six hours ago counts no more
    feed(spark, scratch, [(S.AQI_TOPIC, {"zone": "Zone 3", "aqi": 1}, T0 + 5.9 * hour, 521),
                          (S.TRAFFIC_TOPIC, {"zone": "Zone 3", "congestion_pct": 3.0}, T0 + 6 * hour, 522)], start)
    assert seen[-1] == ("zone 3", 30, 3.0)  # an older reading does not replace a newer one


def test_zones_share_state_rows(spark, scratch):
    seen, hour = [], dt.timedelta(hours=1)

    def start(stream, checkpoint):
        rows = KS.expiring_latest(stream, "2 hours", "10 minutes", buckets=4).select(
            "norm_zone", "aqi_reading.aqi", "traffic_reading.congestion_pct", "aqi_reading.aqi_kafka_offset")
        return ST.apply_trigger(rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(
            lambda batch, i: seen.extend(tuple(r) for r in batch.collect()))).start()

    def held(query):
        return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1]

    def state_zones():
        state = spark.read.format("statestore").load(os.path.join(scratch, "ckpt"))
        return sorted(z for r in state.collect() for z in json.loads(r.value.groupState.zones))

    rows = [m for i in range(40) for m in readings(f"Zone {i}", T0, 10 * i, i)]
    assert held(feed(spark, scratch, rows + rows[:30], start)) == 4  # forty zones, some messages twice: four rows
    assert sorted(seen) == sorted((f"zone {i}", i, 10.0, 10 * i) for i in range(40))
    seen.clear()
    early = [m for i in range(0, 40, 2) for m in readings(f"Zone {i}", T0 + hour, 500 + 10 * i, 100 + i)]
    feed(spark, scratch, early + readings("Zone 1", T0 + 3 * hour, 999, 7)[:1], start)
    assert sorted(seen) == sorted([("zone 1", 7, None, 999)] + [(f"zone {i}", 100 + i, 10.0, 500 + 10 * i) for i in range(0, 40, 2)])
    seen.clear()
    # the odd zones fell silent, but their buckets hold zones that did not
    assert state_zones() == sorted(["zone 1", *[f"zone {i}" for i in range(0, 40, 2)]])
    feed(spark, scratch, readings("Zone 3", T0 + 3 * hour, 1100, 30)[:1] + readings("Zone 2", T0 + 2.9 * hour, 1110, 31)[:1], start)
    assert sorted(seen) == [("zone 2", 31, 10.0, 1110), ("zone 3", 30, None, 1100)]
    last = feed(spark, scratch, readings("Zone 2", T0 + 9 * hour, 1200, 32), start)
    assert held(last) == 1 and state_zones() == ["zone 2"]


def test_expiring_stream_writes_documents(spark, scratch):
    sink = DocumentSink(os.path.join(scratch, "docs"))
    feed(spark, scratch, readings("Kothrud", T0, 1, 250) + readings("Aundh", T0, 11)[:2],
         lambda stream, checkpoint: KS.start_expiring_unified(stream, sink, checkpoint, "1 day", "1 hour", stamp=lambda b: ntz(AS_OF)))
    assert kept(spark, sink) == {("Kothrud", AS_OF): 250}


# --- late rows, repeats -------------------------------------------------------------------------

def aqi(zone, seconds, offset, value):
    return (S.AQI_TOPIC, {"zone": zone, "aqi": value, "n": offset}, T0 + dt.timedelta(seconds=seconds), offset)


def test_late_rows_correct_the_closed_buckets(spark, scratch):
    table = KS.TrendTable(os.path.join(scratch, "trends"), "30 seconds", "1 minute")

    def start(stream, checkpoint):
        return KS.start_corrected_trends(stream, table, checkpoint)

    feed(spark, scratch, [aqi("A", 0, 1, 10), aqi("A", 40, 2, 20), aqi("A", 200, 3, 30)], start)
    feed(spark, scratch, [aqi("A", 10, 4, 40), aqi("A", 150, 5, 50), aqi("A", 400, 6, 60)], start)

    def shown(corrected):
        return {int((r.time - T0).total_seconds()): (r.messages, r.avg_aqi, r.late_messages) for r in table.read(spark, corrected).collect()}

    append = {0: (1, 10.0, 0), 30: (1, 20.0, 0), 150: (1, 50.0, 0), 180: (1, 30.0, 0)}
    assert shown(False) == append and shown(True) == append | {0: (2, 25.0, 1)}
    assert [r.kafka_offset for r in table.late_rows(spark).collect()] == [4]
    both = ST.reading_trends(msg(spark, [aqi("A", *x) for x in ((0, 1, 10), (40, 2, 20), (200, 3, 30), (10, 4, 40), (150, 5, 50))]))
    assert {(r.time, r.messages, r.avg_aqi) for r in both.collect()} == {(r.time, r.messages, r.avg_aqi) for r in table.read(spark).collect()}
    table(msg(spark, [aqi("A", 10, 4, 40), aqi("A", 150, 5, 50), aqi("A", 400, 6, 60)]), 1)  # the last batch replayed
    assert shown(True) == append | {0: (2, 25.0, 1)}
    table.fold(spark, 1)
    feed(spark, scratch, [aqi("A", 20, 7, 70), aqi("A", 600, 8, 1)], start)
    assert shown(True)[0] == (3, 40.0, 2) and len(os.listdir(os.path.join(scratch, "trends", "partials"))) == 1


def test_a_trend_table_without_batches_is_empty(spark, scratch):
    table = KS.TrendTable(os.path.join(scratch, "none"))
    assert table.read(spark).count() == table.late_rows(spark).count() == 0


def test_repeats_are_dropped_within_the_delay(spark, scratch):
    counts = []

    def start(stream, checkpoint):
        rows = KS.deduplicated(stream, "1 minute")
        return ST.apply_trigger(rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
            lambda batch, i: counts.extend(r.kafka_offset for r in batch.collect()))).start()

    payload = {"zone": "A", "aqi": 1}
    at = lambda s: T0 + dt.timedelta(seconds=s)
    feed(spark, scratch, [(S.AQI_TOPIC, payload, at(0), 1), (S.TRAFFIC_TOPIC, payload, at(0), 2)], start)
    feed(spark, scratch, [(S.AQI_TOPIC, payload, at(20), 3)], start)  # sent again
    feed(spark, scratch, [(S.AQI_TOPIC, {"zone": "B"}, at(300), 4)], start)  # time goes on
    feed(spark, scratch, [(S.AQI_TOPIC, {"zone": "C"}, at(310), 5)], start)
    feed(spark, scratch, [(S.AQI_TOPIC, payload, at(320), 6)], start)  # the same reading minutes later is a reading of its own
    assert sorted(counts) == [1, 2, 4, 5, 6]


# --- offset ledger ------------------------------------------------------------------------------

def test_each_run_reads_the_new_offsets_only(spark, scratch):
    landed, ledger = C.messages(spark, SF_SMALL), OffsetLedger(os.path.join(scratch, "ledger"))
    sink = DocumentSink(os.path.join(scratch, "docs"), writer="ledger")
    last, total = landed.agg(F.max("offset")).first()[0], landed.count()
    assert ledger.starting_offsets(spark) is None
    for share in (0.3, 0.3, 0.8, 1.0):  # the second run has nothing new
        ledger_batch(within_offsets(landed, ending=int(last * share) + 1), ledger, AS_OF, sink)
    ranges = ledger.ranges(spark)
    assert ranges.agg(F.sum("messages")).first()[0] == total
    assert ranges.filter("run = 1").count() == 0 and ledger.runs(spark) == [0, 1, 2, 3]
    want = U.unified_snapshot(message_columns(landed), AS_OF)
    assert rows_of(sink.read_all(spark).filter("batch_id = 3").select(*S.UNIFIED_COLUMNS)) == rows_of(want)
    first, second = (sink.read_all(spark).filter(f"batch_id = {i}").select(*S.UNIFIED_COLUMNS) for i in (0, 1))
    assert rows_of(first) == rows_of(second)
    assert json.loads(ledger.starting_offsets(spark))[S.AQI_TOPIC]["0"] >= last - 2
    landed.write.parquet(os.path.join(scratch, "landed"))  # a topic's files: the predicate reaches their scan
    assert ledger.unread(spark.read.parquet(os.path.join(scratch, "landed"))).count() == 0
    plan = executed_plan(ledger.unread(spark.read.parquet(os.path.join(scratch, "landed"))))
    assert "GreaterThanOrEqual(offset," in plan, plan


def test_a_failed_run_is_run_again(spark, scratch):
    ledger, out = OffsetLedger(os.path.join(scratch, "ledger")), {}
    two = msg(spark, readings("Kothrud", T0, 1) + readings("Kothrud", T0 + dt.timedelta(minutes=1), 11, 55))

    def write(documents, run):
        if run == 1 and not out.get(1):
            out[1] = True
            raise OSError("sink")
        out[run] = [r.aqi for r in documents.collect()]

    assert ledger_batch(within_offsets(two, ending=5), ledger, AS_OF, write) == 0
    with pytest.raises(OSError):
        ledger_batch(two, ledger, AS_OF, write)
    assert ledger.runs(spark) == [0]
    assert ledger_batch(two, ledger, AS_OF, write) == 1 and out == {0: [100], 1: [55]}
    assert ledger.ranges(spark).filter("run = 1").agg(F.sum("messages")).first()[0] == 3
    late = ledger_batch(two, ledger, AS_OF, write, lookback_minutes=5)
    assert out[late] == []  # readings older than the lookback do not count


# --- frequent values, publishing ----------------------------------------------------------------

def test_top_values_are_exact(spark):
    rnd = random.Random(1)
    skewed = [(str(min(int(rnd.paretovariate(0.7)), 10**6)),) for _ in range(20_000)] + [(None,)] * 50
    even = [(str(i % 5000),) for i in range(20_000)]
    for rows, tracked in ((skewed, 512), (even, 64), (even, 8192), (skewed[:3], 64), ([(None,)], 64)):
        frame = spark.createDataFrame(rows, "v string").repartition(4)
        want = frame.filter("v is not null").groupBy("v").count().orderBy(F.desc("count"), "v").limit(10).collect()
        assert [(r.name, r.value, r.rank) for r in M.top_values(frame, "v", 10, tracked).collect()] == [
            (r.v, r["count"], i) for i, r in enumerate(want, 1)]


def test_a_batch_published_again_reads_back_once(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "zone string, k int")
    once = batch_messages(rows, "t", 4)
    again = batch_messages(rows.repartition(3), "t", 4).union(batch_messages(rows.limit(1), "t", 5))
    columns = ("key", "value", "topic", "0 AS partition")
    sent = once.selectExpr(*columns, "1L AS offset").union(again.selectExpr(*columns, "2L AS offset"))
    other = spark.createDataFrame([(None, bytearray(b"x"), "t", 0, 3)] * 2, sent.schema)
    got = distinct_messages(sent.union(other)).groupBy(F.col("value").cast("string").alias("v"), "offset").count().collect()
    assert {(r.v, r.offset): r["count"] for r in got} == {('{"zone":"a","k":1}', 1): 2, ('{"zone":"b","k":null}', 1): 1, ('{"zone":"a","k":1}', 2): 1,
                                                          ("x", 3): 2}
