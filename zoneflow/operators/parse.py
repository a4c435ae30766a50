"""Topic routing, JSON parsing, per-feed renaming, and parse rejects (PRJ-01..PRJ-04, PRJ-08, SNK-06).

Input is the frame from ``sources.kafka.message_columns`` (topic, json_payload, kafka_time,
kafka_partition, kafka_offset). Everything is a projection or filter, so it fuses with the scan
in one codegen stage and works unchanged on streaming frames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from zoneflow import schemas as S
from zoneflow.functions.rules import normalize_zone

KAFKA_COLS = ("kafka_time", "kafka_partition", "kafka_offset")


def _clean(field: Column, dtype) -> Column:
    """A bare NaN in a double field becomes null, so threshold rules read it as missing."""
    if isinstance(dtype, DoubleType):
        return F.nanvl(field, F.lit(None).cast("double"))
    return field


def feed_columns(topic: str, parsed: Column, with_kafka: bool = True) -> list[Column]:
    """The renamed columns of one feed from a parsed struct column (PRJ-03, PRJ-04)."""
    schema = S.FEED_SCHEMAS[topic]
    types = {f.name: f.dataType for f in schema.fields}
    p = S.FEED_PREFIX[topic]
    cols = [normalize_zone(parsed["zone"]).alias("norm_zone")]
    cols += [_clean(parsed[src], types[src]).alias(out) for src, out in S.FEED_COLUMNS[topic]]
    if with_kafka:
        cols += [F.col(k).alias(f"{p}_{k}") for k in KAFKA_COLS]
    return cols


def route(messages: DataFrame, topic: str) -> DataFrame:
    """PRJ-01: messages of one topic."""
    return messages.filter(F.col("topic") == topic)


def parse_feed(messages: DataFrame, topic: str) -> DataFrame:
    """PRJ-01..04: route one topic, parse its JSON and rename the fields with the feed prefix."""
    parsed = F.from_json("json_payload", S.FEED_SCHEMAS[topic])
    return (route(messages, topic)
            .select(parsed.alias("d"), *KAFKA_COLS)
            .select(*feed_columns(topic, F.col("d"))))


def parse_aqi(messages: DataFrame) -> DataFrame:
    return parse_feed(messages, S.AQI_TOPIC)


def parse_traffic(messages: DataFrame) -> DataFrame:
    return parse_feed(messages, S.TRAFFIC_TOPIC)


def parse_weather(messages: DataFrame) -> DataFrame:
    return parse_feed(messages, S.WEATHER_TOPIC)


def parse_all(messages: DataFrame) -> DataFrame:
    """All three feeds in one pass: topic, norm_zone, Kafka columns, and one reading struct per
    feed (``aqi_reading``, ``traffic_reading``, ``weather_reading``), non-null only for its topic.

    Each payload is parsed once: the typed struct is produced in one projection (only the
    matching topic's branch runs) and split into fields in the next. Field access straight on
    ``from_json`` would let the optimizer split it into one pruned parse per field.
    The reading struct is non-null even when its fields are null, so "latest reading" logic
    carries a whole reading and never fills a null field from an older message.
    """
    topic = F.col("topic")
    parsed = [F.when(topic == t, F.from_json("json_payload", S.FEED_SCHEMAS[t])).alias(f"_p{i}")
              for i, t in enumerate(S.TOPICS)]
    readings = [F.expr(_reading_sql(t, f"_p{i}")).alias(f"{S.FEED_PREFIX[t]}_reading")
                for i, t in enumerate(S.TOPICS)]
    zone = normalize_zone(F.coalesce(*[F.col(f"_p{i}.zone") for i in range(len(S.TOPICS))]))
    return (messages
            .select("topic", *KAFKA_COLS, *parsed)
            .select("topic", zone.alias("norm_zone"), *KAFKA_COLS, *readings))


def zone_of_payload() -> Column:
    """The normalised zone of a message's payload: a parse of that one field (null where the payload
    is no JSON object)."""
    return normalize_zone(F.from_json("json_payload", "zone string")["zone"])


def parse_newest(newest: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Reading structs of raw winners: columns ``_raw_<prefix>`` (a struct of json_payload and the Kafka
    columns, or null) become ``<prefix>_reading``, as ``parse_all`` gives them; ``keep`` stays."""
    raws = {t: f"_raw_{S.FEED_PREFIX[t]}" for t in S.TOPICS}
    parsed = [F.from_json(F.col(f"{raw}.json_payload"), S.FEED_SCHEMAS[t]).alias(f"_p{i}")
              for i, (t, raw) in enumerate(raws.items())]
    readings = [F.expr(_reading_sql(t, f"_p{i}", f"{raw}.")).alias(f"{S.FEED_PREFIX[t]}_reading")
                for i, (t, raw) in enumerate(raws.items())]
    return newest.select(*keep, *raws.values(), *parsed).select(*keep, *readings)


def _reading_sql(topic: str, parsed: str, kafka: str = "") -> str:
    """The reading struct of one feed from its parsed struct column, as one SQL expression: the
    same fields as ``feed_columns`` (NaN doubles to null, Kafka columns with the feed prefix),
    null when the message is not of this feed. Given as text, it is one call to the JVM to build
    rather than several per field."""
    types = {f.name: f.dataType for f in S.FEED_SCHEMAS[topic].fields}
    fields = []
    for src, out in S.FEED_COLUMNS[topic]:
        v = f"{parsed}.`{src}`"
        if isinstance(types[src], DoubleType):
            v = f"nanvl({v}, CAST(NULL AS DOUBLE))"
        fields.append(f"'{out}', {v}")
    fields += [f"'{S.FEED_PREFIX[topic]}_{k}', {kafka}`{k}`" for k in KAFKA_COLS]
    return f"CASE WHEN {parsed} IS NOT NULL THEN named_struct({', '.join(fields)}) END"


_CORRUPT = "_corrupt_record"


def _any_feed() -> StructType:
    """All fields of all feeds, and the parser's own column for what did not parse. Feeds that share a field give it one type."""
    fields: dict[str, StructField] = {}
    for t in S.TOPICS:
        for f in S.FEED_SCHEMAS[t].fields:
            if fields.setdefault(f.name, f).dataType != f.dataType:
                raise TypeError(f"{f.name} has two types")
    return StructType([*fields.values(), StructField(_CORRUPT, StringType())])


def _exact_reason() -> Column:
    """The reason of a message that did not parse as a whole: its payload is parsed as text values and as its topic's struct, and these are
    compared field by field."""
    topic = F.col("topic")
    forms = F.struct(topic.alias("topic"), F.from_json("json_payload", "map<string,string>").alias("raw"), *[
        F.when(topic == t, F.from_json("json_payload", S.FEED_SCHEMAS[t])).alias(f"_t{i}") for i, t in enumerate(S.TOPICS)])

    def reason(p: Column) -> Column:
        bad_type = F.lit(False)
        for i, t in enumerate(S.TOPICS):
            lost = [p["raw"][f.name].isNotNull() & p[f"_t{i}"][f.name].isNull() for f in S.FEED_SCHEMAS[t].fields]
            bad_type = F.when(p["topic"] == t, reduce(Column.__or__, lost)).otherwise(bad_type)
        zone = normalize_zone(p["raw"]["zone"])
        return (F.when(p["raw"].isNull(), "malformed_json").when(zone.isNull() | (zone == ""), "missing_zone")
                .when(bad_type, "bad_field_type"))

    return F.transform(F.array(forms), reason)[0]  # each form is parsed once for all the comparisons


def with_reject_reason(messages: DataFrame) -> DataFrame:
    """PRJ-08: add ``reject_reason`` (null when the message is usable).

    Reasons: ``unknown_topic``, ``malformed_json`` (not a JSON object), ``missing_zone``
    (null or blank zone), ``bad_field_type`` (a present field of the wrong type; it would be read
    as null). Nothing is dropped here: the caller splits valid and rejected rows. The payload is parsed once, with the fields
    of all feeds and the parser's column for what did not parse; only a message that has something there is looked at more closely.
    """
    topic = F.col("topic")
    # One row in, one row out: what a generator made is not inlined into a later filter, where each
    # check would parse the payload again.
    parsed = messages.select("*", F.explode(F.array(F.from_json("json_payload", _any_feed()))).alias("_parsed"))
    zone, corrupt = normalize_zone(F.col("_parsed.zone")), F.col("_parsed").isNull() | F.col(f"_parsed.{_CORRUPT}").isNotNull()
    reason = (F.when(~topic.isin(*S.TOPICS) | topic.isNull(), "unknown_topic").when(corrupt, _exact_reason())
              .when(zone.isNull() | (zone == ""), "missing_zone"))
    return parsed.withColumn("reject_reason", reason).drop("_parsed")


def valid_messages(messages: DataFrame) -> DataFrame:
    """Usable messages, with the columns of ``messages``."""
    return with_reject_reason(messages).filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_messages(messages: DataFrame) -> DataFrame:
    """The other messages: topic, raw payload, Kafka columns and ``reject_reason``."""
    return with_reject_reason(messages).filter(F.col("reject_reason").isNotNull()).select(
        "topic", "json_payload", *KAFKA_COLS, "reject_reason")


def reject_report(messages: DataFrame) -> DataFrame:
    """SNK-06: message counts per (topic, outcome); the outcome is ``ok`` or the reject reason."""
    return (with_reject_reason(messages)
            .groupBy("topic", F.coalesce("reject_reason", F.lit("ok")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("messages")))


def expand_payload(messages: DataFrame, topic: str) -> DataFrame:
    """PRJ-02/03 as the per-topic streams do it: the payload's own field names (``data.*``)."""
    schema = S.FEED_SCHEMAS[topic]
    return (route(messages, topic)
            .select(F.from_json("json_payload", schema).alias("data"))
            .select(*[_clean(F.col(f"data.{f.name}"), f.dataType).alias(f.name)
                      for f in schema.fields]))
