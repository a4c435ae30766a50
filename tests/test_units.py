"""Helpers without a queries() entry: options, retries, ranges, history segments."""

import datetime as dt
import zoneinfo

import pytest

from zoneflow.functions.times import check_range_minutes
from zoneflow.operators import history as H
from zoneflow.operators import metrics as M
from zoneflow.sinks.documents import with_retries
from zoneflow.plans import fixtures
from zoneflow.sources.kafka import SaslLogin, kafka_options, lookback_options, message_columns

AS_OF = dt.datetime(2024, 1, 31)


def test_kafka_options():
    o = kafka_options(["a:1", "b:2"], starting_offsets="earliest", min_partitions=64)
    assert o == {"kafka.bootstrap.servers": "a:1,b:2", "minPartitions": "64",
                 "subscribe": "aqi-data,traffic-data,weather-data", "startingOffsets": "earliest"}
    s = kafka_options(["a:1"], login=SaslLogin("u", 'p"\\x'), ca_pem="X\\nY")
    assert s["kafka.security.protocol"] == "SASL_SSL"
    assert s["kafka.sasl.jaas.config"].endswith('required username="u" password="p\\"\\\\x";')
    assert s["kafka.ssl.truststore.certificates"] == "X\\nY"  # taken as it is
    for half in (("u", ""), ("", "p")):
        with pytest.raises(ValueError):
            SaslLogin(*half)
    with pytest.raises(ValueError):
        kafka_options([])


def test_lookback_needs_an_instant():
    o = kafka_options(["a:1"])
    half_past = dt.datetime(2024, 1, 1, 0, 30, tzinfo=dt.timezone.utc)
    lb = lookback_options(o, half_past, 30)
    assert lb["startingTimestamp"] == str(int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000))
    local = half_past.astimezone(zoneinfo.ZoneInfo("Asia/Kolkata"))
    assert lookback_options(o, local, 30) == lb
    assert "startingOffsets" not in lb and lb["endingOffsets"] == "latest"
    assert lookback_options(o, AS_OF, starting_offsets="earliest")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        lookback_options(o, AS_OF)


def test_retries_back_off_then_raise():
    waits, calls = [], []

    def flaky(attempt):
        calls.append(attempt)
        if attempt < 3:
            raise OSError("down")
        return "ok"
    assert with_retries(flaky, sleep=waits.append) == "ok"
    assert calls == [1, 2, 3] and waits == [2.0, 4.0]
    with pytest.raises(OSError):
        with_retries(lambda a: (_ for _ in ()).throw(OSError("x")), sleep=lambda s: None)


@pytest.mark.parametrize("bad", [0, 1441, -5])
def test_range_bounds(bad):
    with pytest.raises(ValueError):
        check_range_minutes(bad)
    assert check_range_minutes(1) == 1 and check_range_minutes(1440) == 1440


def test_empty_range_summary(spark):
    hist = H.replay_history(message_columns(fixtures.read_messages(spark, "/root/testdata/sf0.001")), AS_OF)
    row = M.summary(hist, dt.datetime(2020, 1, 1), 60).collect()
    assert len(row) == 1 and row[0]["zone_count"] == 0 and row[0]["record_count"] == 0
    assert row[0]["avg_aqi"] is None and row[0]["pollution_trap_count"] == 0
    assert row[0]["alerts"] == row[0]["aqi_statuses"] == row[0]["traffic_statuses"] == {}


@pytest.mark.parametrize("segment", ["hour", "week", "month"])
def test_history_segments_agree(spark, segment):
    """The carry-in across segments gives the same history whatever the segment size."""
    messages = message_columns(fixtures.read_messages(spark, "/root/testdata/sf0.001"))
    base = H.replay_history(messages, AS_OF, segment="day")
    other = H.replay_history(messages, AS_OF, segment=segment)
    assert sorted(map(tuple, base.collect())) == sorted(map(tuple, other.collect()))


@pytest.mark.parametrize("since", [dt.datetime(2024, 1, 30), dt.datetime(2024, 1, 15, 7, 20), dt.datetime(2023, 1, 1)])
def test_bounded_replay_equals_the_whole_one_in_range(spark, since):
    messages = message_columns(fixtures.read_messages(spark, "/root/testdata/sf0.001"))
    whole = H.replay_history(messages, AS_OF).collect()
    bounded = H.replay_history(messages, AS_OF, since=since).collect()
    want = sorted(tuple(r) for r in whole if r.synchronized_time >= since)
    assert want and sorted(map(tuple, bounded)) == want


def test_no_default_caps(spark):
    """60 zones at 10 times each: every zone and value is in every answer; bounds only when asked for."""
    rows = [(f"z{i:02}", AS_OF - dt.timedelta(minutes=t), i, float(i), f"alert {i}", f"s{i}", f"t{i}", f"w{i}", False)
            for i in range(60) for t in range(10)]
    docs = spark.createDataFrame(rows, "zone string, synchronized_time timestamp_ntz, aqi int, congestion_pct double, "
                                 "city_alert string, aqi_status string, traffic_status string, weather_condition string, road_closure boolean")
    docs = docs.selectExpr("*", "1.0D AS temperature_c", "1.0D AS current_speed_kmph", "1 AS humidity_pct", "1.0D AS rainfall_mm")
    assert M.latest_documents(docs, AS_OF).count() == 60 == M.zones_online(docs, AS_OF).first()[0]
    assert M.latest_documents(docs, AS_OF, scan_limit=30).count() == 30
    assert M.zone_analytics(docs, AS_OF).count() == 60 and M.zone_analytics(docs, AS_OF, size=20).count() == 20
    assert M.status_breakdown(docs, AS_OF).count() == 240 and M.status_breakdown(docs, AS_OF, size=10).count() == 40
    assert {len(r.counts) for r in M.summary_maps(docs, AS_OF).collect()} == {60}
    row = M.summary(docs, AS_OF).first()
    assert row.zone_count == 60 and len(row.alerts) == 60 and row.alerts["alert 7"] == 10 and row.avg_aqi == 29.5


def test_sync_date_prunes_with_the_time(spark):
    docs = spark.createDataFrame([(AS_OF - dt.timedelta(days=d),) for d in range(4)], "synchronized_time timestamp_ntz")
    dated = docs.selectExpr("*", "CAST(synchronized_time AS DATE) AS sync_date")
    assert M.in_range(dated, AS_OF, 1440).count() == M.in_range(docs, AS_OF, 1440).count() == 2


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_texts_agree_for_instants_and_local_times(spark, zone):
    from zoneflow.functions.text import document_key, document_time_text, store_time_text
    from zoneflow.sinks.documents import render_documents
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT 'K' AS zone, TIMESTAMP_NTZ'2024-01-01 07:30:00' AS synchronized_time").selectExpr(
            "*", "CAST('2024-01-01T02:00:00Z' AS TIMESTAMP) AS instant")
        for c in ("synchronized_time", "instant"):
            row = df.select(document_key("zone", c).alias("key"), document_time_text(c).alias("doc"), store_time_text(c).alias("store")).first()
            assert (row.key, row.doc, row.store) == ("K-2024-01-01T07:30:00+05:30", "2024-01-01T07:30:00+05:30", "2024-01-01T02:00:00.000Z")
            one = df.selectExpr("zone", f"{c} AS synchronized_time")
            assert render_documents(one).first().doc_id == row.key
            inside = M.in_range(one, dt.datetime(2024, 1, 1, 7, 30), 1)
            assert inside.count() == 1 and M.in_range(one, dt.datetime(2024, 1, 1, 7, 29), 1).count() == 0
            m = one.selectExpr("'t' AS topic", "CAST('x' AS BINARY) AS value", "synchronized_time AS timestamp", "0 AS partition", "0L AS offset")
            times = message_columns(m)
            assert dict(times.dtypes)["kafka_time"] == "timestamp_ntz"
            assert times.first().kafka_time == dt.datetime(2024, 1, 1, 7, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_air_quality_answers(spark):
    from zoneflow.sources.feeds import flatten_aqi_feed
    data = '{"aqi":90,"iaqi":{"pm25":{"v":1.5}},"time":{"iso":"T"}}'
    polls = ['{"status":"ok","data":%s}' % data, '{"status":"error","data":%s}' % data, data, "no json", None,
             '{"status":"ok","data":{"iaqi":{}}}', '{"status":"ok"}']
    frame = spark.createDataFrame([(i, AS_OF, p) for i, p in enumerate(polls)], "poll_id int, fetched_at timestamp_ntz, payload string")
    got = {r.poll_id: r for r in flatten_aqi_feed(frame).collect()}
    assert (got[0].base_aqi, got[0].base_pm25, got[0].base_no2, got[0].timestamp) == (90, 1.5, None, "T")
    for i in (1, 2, 3, 4, 6):
        assert tuple(got[i])[2:] == (42, 12.0, 35.0, 15.0, 5.0, 31.0, 55.0, 8.0, "2024-01-31T00:00:00+05:30"), i
    assert got[5].base_aqi == 50 and got[5].base_pm25 is None


def test_weather_answers_fall_back_as_a_whole(spark):
    from zoneflow.operators.zones import zone_dimension
    from zoneflow.sources.feeds import flatten_weather_feed
    now, hourly = '{"temperature":20.5,"windspeed":3.0}', '{"relativehumidity_2m":[50],"precipitation":[0.5],"surface_pressure":[990.0]}'
    polls = ['{"current_weather":%s,"hourly":%s}' % (now, hourly), '{"current_weather":%s}' % now,
             '{"current_weather":%s,"hourly":%s}' % (now, hourly.replace("[0.5]", "[]")), "{}", None,
             '{"current_weather":{"temperature":20.5},"hourly":%s}' % hourly]
    frame = spark.createDataFrame([(i, "Kothrud" if i else "Elsewhere", AS_OF, p) for i, p in enumerate(polls)],
                                  "poll_id int, zone_name string, fetched_at timestamp_ntz, payload string")
    got = {r.poll_id: r for r in flatten_weather_feed(frame, zone_dimension(spark)).collect()}
    values = ("temperature_c", "wind_speed_kmph", "humidity_pct", "rainfall_mm", "pressure_hpa")
    assert tuple(got[0][c] for c in values) == (20.5, 3.0, 50, 0.5, 990.0)
    assert got[0].zone == "Elsewhere" and got[0].lat is None  # an unknown zone's reading stays
    for i in range(1, 6):
        assert tuple(got[i][c] for c in values) == (32.0, 10.0, 60, 0.0, 1008.0), i


def test_published_text_keeps_nulls(spark):
    from zoneflow.sinks.publish import to_messages
    sent = to_messages(spark.createDataFrame([(1, None)], "a int, b string"), "t").first()
    assert bytes(sent.value) == b'{"a":1,"b":null}'


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from zoneflow.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda k, d=None: d)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: conf)
        with pytest.raises(ValueError):
            ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_intermediate_tables_go_with_the_application(scratch):
    """A run in a session of its own leaves no intermediate folder behind."""
    import pathlib
    import subprocess
    import sys
    code = f"""
import sys; sys.path.insert(0, {str(pathlib.Path(__file__).parent.parent)!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {scratch!r}).config("spark.sql.shuffle.partitions", "2").getOrCreate())
from zoneflow.plans import catalog
assert catalog.QUERIES["summary"](spark, "/root/testdata/sf0.001").count() == 1
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    left = [p for p in pathlib.Path(scratch).rglob("*.parquet")]
    assert not left


def test_debug_sinks(spark, capsys):
    """SNK-08 vertical display and SNK-01 console stream (append, one pass)."""
    from zoneflow.sinks.documents import show_vertical
    from zoneflow.streaming.streams import start_console
    from zoneflow.streaming.tagging import tag_weather
    show_vertical(spark.createDataFrame([("Kothrud", 1)], "zone string, n int"))
    assert "zone | Kothrud" in capsys.readouterr().out
    stream = tag_weather(message_columns(fixtures.read_message_stream(spark, "/root/testdata/sf0.001")))
    q = start_console(stream, trigger="availableNow")
    q.awaitTermination()
    assert q.lastProgress is not None and q.lastProgress["numInputRows"] > 0


def test_cluster_conf_applies(spark):
    from zoneflow.session import CLUSTER_CONF, apply_cluster_conf
    before = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    before["spark.sql.shuffle.partitions"] = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        apply_cluster_conf(spark, shuffle_partitions=16)
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "16"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_document_text_keeps_fraction_offset_and_nulls(spark):
    import json

    from zoneflow.sinks.documents import render_documents
    df = spark.createDataFrame(
        [(" FC ROAD ", dt.datetime(2024, 1, 1, 8, 0), dt.datetime(2024, 1, 1, 7, 36, 12, 733472), None),
         ("Kothrud", dt.datetime(2024, 1, 1, 9, 0), dt.datetime(2024, 1, 1, 8, 59, 1, 500), 42)],
        "zone string, synchronized_time timestamp_ntz, aqi_kafka_time timestamp_ntz, aqi int")
    got = {r.doc_id: json.loads(r.document) for r in render_documents(df).collect()}
    assert got[" FC ROAD -2024-01-01T08:00:00+05:30"] == {
        "zone": " FC ROAD ", "synchronized_time": "2024-01-01T08:00:00+05:30",
        "aqi_kafka_time": "2024-01-01T07:36:12.733472+05:30", "aqi": None}
    assert got["Kothrud-2024-01-01T09:00:00+05:30"]["aqi_kafka_time"] == \
        "2024-01-01T08:59:01.000500+05:30"


def test_instants_render_as_local_wall_clock(spark):
    import json
    from zoneflow.sinks.documents import render_documents
    # an instant (timestamp) column: 02:06:12.733472 UTC is 07:36:12.733472 in the local zone
    df = spark.sql("SELECT 'Kothrud' AS zone, TIMESTAMP_NTZ'2024-01-01 08:00:00' AS synchronized_time, "
                   "to_utc_timestamp(TIMESTAMP_NTZ'2024-01-01 02:06:12.733472', 'UTC') AS kafka_time")
    assert dict(df.dtypes)["kafka_time"] == "timestamp"
    doc = json.loads(render_documents(df).first().document)
    assert doc["kafka_time"] == "2024-01-01T07:36:12.733472+05:30"


def test_processing_time_is_local_wall_clock(spark):
    import zoneinfo

    from zoneflow import schemas as S
    from zoneflow.streaming.streams import processing_time
    got = spark.range(1).select(processing_time().alias("t")).first().t
    now = dt.datetime.now(zoneinfo.ZoneInfo(S.LOCAL_TIME_ZONE)).replace(tzinfo=None)
    assert abs((now - got).total_seconds()) < 120
