"""Malformed and edge-case payloads (FIXTURES.md §8): parse results and reject reasons."""

import pytest
from pyspark.sql import functions as F

from zoneflow import schemas as S
from zoneflow.operators import parse as P

GOOD = '{"sensor_id":"AQI_X_001","zone":"Kothrud","aqi":42,"wind":1.5}'
CASES = [
    ("valid", GOOD),
    ("float_in_int", '{"zone":"Kothrud","aqi":42.7}'),
    ("float_zero_in_int", '{"zone":"Kothrud","aqi":42.0}'),
    ("quoted_number", '{"zone":"Kothrud","aqi":"42"}'),
    ("not_json", "not json at all"),
    ("missing_field", '{"zone":"Kothrud"}'),
    ("out_of_range", '{"zone":"Kothrud","aqi":99999999999}'),
    ("array", '[{"zone":"Kothrud","aqi":42}]'),
    ("two_objects", '{"zone":"Kothrud","aqi":42} {"zone":"Hadapsar","aqi":7}'),
    ("tab_zone", '{"zone":"\\tKothrud ","aqi":42}'),
    ("null_zone", '{"zone":null,"aqi":42}'),
    ("nan", '{"zone":"Kothrud","aqi":42,"wind":NaN}'),
]


def frame(spark):
    rows = [(name, S.AQI_TOPIC, payload, None, 0, i) for i, (name, payload) in enumerate(CASES)]
    return spark.createDataFrame(
        rows, "case string, topic string, json_payload string, kafka_time timestamp_ntz, "
              "kafka_partition int, kafka_offset long")


def test_parse_edge_cases(spark):
    df = frame(spark)
    out = {r["case"]: r for r in df.join(
        P.parse_aqi(df).withColumnRenamed("aqi_kafka_offset", "kafka_offset"), "kafka_offset")
        .collect()}
    assert out["valid"]["aqi"] == 42 and out["valid"]["aqi_wind"] == 1.5
    for case in ("float_in_int", "quoted_number", "out_of_range", "missing_field"):
        assert out[case]["aqi"] is None and out[case]["norm_zone"] == "kothrud", case
    assert out["two_objects"]["aqi"] == 42 and out["two_objects"]["norm_zone"] == "kothrud"
    assert out["not_json"]["norm_zone"] is None and out["array"]["norm_zone"] is None
    assert out["tab_zone"]["norm_zone"] == "\tkothrud"  # trim removes spaces only
    assert out["null_zone"]["norm_zone"] is None
    assert out["nan"]["aqi_wind"] is None  # NaN becomes null at parse


def test_reject_reasons(spark):
    df = frame(spark)
    got = {r["case"]: r["reject_reason"] for r in P.with_reject_reason(df).collect()}
    assert got["valid"] is None and got["tab_zone"] is None and got["nan"] is None
    assert got["two_objects"] is None and got["missing_field"] is None
    assert got["not_json"] == "malformed_json"
    assert got["null_zone"] == "missing_zone"
    for case in ("float_in_int", "quoted_number", "out_of_range"):
        assert got[case] == "bad_field_type", case
    report = {(r["topic"], r["outcome"]): r["messages"] for r in P.reject_report(df).collect()}
    assert sum(report.values()) == len(CASES)  # nothing is lost


def test_unknown_topic(spark):
    df = spark.createDataFrame([("other", "{}", None, 0, 1)],
                               "topic string, json_payload string, kafka_time timestamp_ntz, "
                               "kafka_partition int, kafka_offset long")
    assert P.with_reject_reason(df).first()["reject_reason"] == "unknown_topic"


@pytest.mark.parametrize("topic", S.TOPICS)
def test_one_pass_parse_equals_per_feed_parse(spark, topic):
    """``parse_all`` builds each reading struct from SQL text; its fields and values equal the
    per-feed parse (``parse_feed``), on the edge cases and on the fixture messages."""
    from conftest import SF_SMALL
    from zoneflow.plans import fixtures
    from zoneflow.sources.kafka import message_columns
    edge = frame(spark).drop("case").withColumn("topic", F.lit(topic))
    for msgs in (edge, message_columns(fixtures.read_messages(spark, SF_SMALL))):
        per_feed = P.parse_feed(msgs, topic)
        reading = f"{S.FEED_PREFIX[topic]}_reading"
        one_pass = (P.parse_all(msgs).filter(F.col("topic") == topic)
                    .select("norm_zone", f"{reading}.*"))
        assert one_pass.columns == per_feed.columns
        rows = sorted(map(repr, per_feed.collect()))
        assert rows and rows == sorted(map(repr, one_pass.collect()))


def test_reasons_of_odd_payloads_equal_a_comparison_of_all_fields(spark):
    """The one parse with all feeds' fields finds what parsing as text values and as the topic's struct finds."""
    payloads = ["", "null", "7", '"x"', "[]", '["x"]', '[{"zone":"A"}]', "{", "{}", '{"zone":null}', '{"zone":" "}', '{"zone":"A"}', '{"zone":7}',
                '{"zone":{"a":1}}', '{"zone":"A"} tail', '{"zone":"A","zone":"B"}', '{"zone":"A","lat":"north"}', '{"zone":"A","lat":"1.5"}',
                '{"zone":"A","lat":1}', '{"zone":"A","aqi":1.5}', '{"zone":"A","aqi":99999999999}', '{"zone":"A","aqi":null}',
                '{"zone":"A","pm25":NaN}', '{"zone":"A","aqi":NaN}', '{"zone":"A","congestion_pct":"x"}', '{"zone":"A","humidity_pct":"x"}',
                '{"zone":"A","road_closure":"yes"}', '{"zone":"A","road_closure":1}', '{"zone":" ","lat":"x"}', '{"lat":"x"}', "{'zone':'A'}",
                '{"zone":"A","_corrupt_record":"x"}', '{"zone":"A","other":[1,{"b":2}]}', '{"zone":"A","timestamp":[1]}', None]
    topics = [*S.TOPICS, "other", None]
    rows = [(t, p, None, 0, i) for i, (t, p) in enumerate((t, p) for t in topics for p in payloads)]
    frame = spark.createDataFrame(rows, "topic string, json_payload string, kafka_time timestamp_ntz, kafka_partition int, kafka_offset bigint")

    def plain(topic):
        schema = S.FEED_SCHEMAS[topic]
        both = frame.filter(F.col("topic") == topic).select("kafka_offset", F.from_json("json_payload", "map<string,string>").alias("raw"),
                                                            F.from_json("json_payload", schema).alias("typed")).collect()
        out = {}
        for r in both:
            if r.raw is None:
                out[r.kafka_offset] = "malformed_json"
            elif not (r.raw.get("zone") or "").strip():
                out[r.kafka_offset] = "missing_zone"
            elif any(r.raw.get(f.name) is not None and (r.typed is None or r.typed[f.name] is None) for f in schema.fields):
                out[r.kafka_offset] = "bad_field_type"
            else:
                out[r.kafka_offset] = None
        return out

    got = {r.kafka_offset: r.reject_reason for r in P.with_reject_reason(frame).collect()}
    want = {i: "unknown_topic" for i, (t, *_) in enumerate(rows) if t not in S.TOPICS}
    for t in S.TOPICS:
        want |= plain(t)
    assert got == want, {payloads[i % len(payloads)]: (got[i], want[i]) for i in got if got[i] != want[i]}
    assert len(set(got.values())) == 5
