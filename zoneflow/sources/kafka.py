"""Message sources (SRC-01..SRC-06).

The Kafka reader is kept thin: options in, Kafka-shaped DataFrame out. Everything after it works
on the standard Kafka columns (key, value, topic, partition, offset, timestamp), so the same code
runs on a file-backed stand-in with those columns (see ``zoneflow.plans.fixtures``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow import schemas as S
from zoneflow.functions.times import as_wall_clock, between_inclusive

@dataclass(frozen=True)
class SaslLogin:
    """A SASL login over TLS. Both parts must be given: a half-given login is an error of the
    deployment, not a wish for an unauthenticated connection."""

    username: str
    password: str
    mechanism: str = "PLAIN"
    login_module: str = "org.apache.kafka.common.security.plain.PlainLoginModule"

    def __post_init__(self) -> None:
        if not self.username or not self.password:
            raise ValueError("a login needs a user name and a password")

    def options(self) -> dict[str, str]:
        def quoted(text: str) -> str:
            return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'

        return {"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": self.mechanism,
                "kafka.sasl.jaas.config": f"{self.login_module} required username={quoted(self.username)} "
                                          f"password={quoted(self.password)};"}


def kafka_options(bootstrap_servers: Sequence[str], topics: Sequence[str] = S.TOPICS,
                  starting_offsets: str = "latest", login: SaslLogin | None = None,
                  ca_pem: str | None = None, min_partitions: int | None = None,
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """SRC-05: reader options. Secrets are arguments from the caller, never read from code.

    ``ca_pem`` is the text of a PEM trust store, taken as it is. ``min_partitions`` splits large
    topic partitions into more tasks; ``max_offsets_per_trigger`` bounds a micro-batch.
    """
    if isinstance(bootstrap_servers, str) or isinstance(topics, str):
        raise TypeError("servers and topics are lists")
    if not bootstrap_servers or not topics:
        raise ValueError("at least one server and one topic are needed")
    optional = {"minPartitions": min_partitions, "maxOffsetsPerTrigger": max_offsets_per_trigger}
    trust = {"kafka.ssl.truststore.type": "PEM", "kafka.ssl.truststore.certificates": ca_pem} if ca_pem else {}
    return {"kafka.bootstrap.servers": ",".join(bootstrap_servers), "subscribe": ",".join(topics),
            "startingOffsets": starting_offsets, **(login.options() if login else {}), **trust,
            **{k: str(v) for k, v in optional.items() if v is not None}}


def lookback_options(options: dict[str, str], as_of: dt.datetime,
                     lookback_minutes: int = S.BATCH_LOOKBACK_MINUTES,
                     starting_offsets: str | None = None) -> dict[str, str]:
    """SRC-04: bounded range options: explicit offsets, else ``as_of - lookback`` as a start time.

    ``as_of`` is an instant: a time without a zone is refused, as elsewhere such times are local."""
    opts = dict(options)
    opts.pop("startingOffsets", None)
    if starting_offsets:
        opts["startingOffsets"] = starting_offsets
    else:
        if as_of.tzinfo is None:
            raise ValueError("as_of needs a time zone")
        start = as_of - dt.timedelta(minutes=lookback_minutes)
        opts["startingTimestamp"] = str(int(start.timestamp() * 1000))
        # Without this, a partition with no record after the start time fails the read.
        opts["startingOffsetsByTimestampStrategy"] = "latest"
    opts["endingOffsets"] = "latest"
    return opts


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """SRC-03: bounded batch read (needs the Kafka connector on the classpath)."""
    return spark.read.format("kafka").options(**options).load()


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """SRC-01/02: unbounded read of one or more topics."""
    return spark.readStream.format("kafka").options(**options).load()


def message_columns(messages: DataFrame) -> DataFrame:
    """SRC-01 + SRC-06: topic, payload text, Kafka time, and the (partition, offset) tie-breakers.

    The broker's time is an instant (``timestamp``); it becomes local wall-clock
    ``timestamp_ntz`` here, once, and everything after works on that."""
    return messages.select(
        "topic",
        F.col("value").cast("string").alias("json_payload"),
        as_wall_clock("timestamp").alias("kafka_time"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def decode_messages(messages: DataFrame) -> DataFrame:
    """SRC-06: key and value bytes as text."""
    return messages.select(
        "topic", "partition", "offset", "timestamp",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def single_topic(messages: DataFrame, topic: str) -> DataFrame:
    """SRC-02: the messages of one topic (a ``subscribe=<topic>`` source)."""
    return messages.filter(F.col("topic") == topic)


def within_lookback(df: DataFrame, as_of: dt.datetime, lookback_minutes: int,
                    time_col: str = "kafka_time") -> DataFrame:
    """SRC-04 on a landed table: keep ``as_of - lookback <= time <= as_of``.

    A plain range predicate, so it reaches the Parquet scan as a pushed filter.
    """
    start = as_of - dt.timedelta(minutes=lookback_minutes)
    return df.filter(between_inclusive(time_col, start, as_of))


def within_offsets(messages: DataFrame, starting: int | None = None,
                   ending: int | None = None) -> DataFrame:
    """SRC-03 on a landed table: keep ``starting <= offset < ending`` (None = open end)."""
    cond = F.lit(True)
    if starting is not None:
        cond = cond & (F.col("offset") >= starting)
    if ending is not None:
        cond = cond & (F.col("offset") < ending)
    return messages.filter(cond)


def topic_profile(messages: DataFrame) -> DataFrame:
    """SRC-07: rows per topic."""
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("count"))


def message_sample(messages: DataFrame, n: int = 20) -> DataFrame:
    """SRC-08: the first ``n`` messages in (partition, offset) order, decoded."""
    return (decode_messages(messages)
            .orderBy("partition", "offset")
            .limit(n)
            .select("topic", "timestamp", "key", "value", "offset"))
