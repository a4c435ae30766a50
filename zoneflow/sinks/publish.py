"""Publishing rows as topic messages (SNK-07, SC-13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.text import json_encode


def to_messages(df: DataFrame, topic: str, key: str | Column | None = None,
                time_col: str | None = None) -> DataFrame:
    """Rows as (key, value, topic[, timestamp]) with the row encoded as one JSON object."""
    cols = [(F.col(key) if isinstance(key, str) else key).cast("binary").alias("key")
            if key is not None else F.lit(None).cast("binary").alias("key"),
            F.encode(json_encode(*[c for c in df.columns if c != time_col]), "UTF-8").alias("value"),
            F.lit(topic).alias("topic")]
    if time_col:
        cols.append(F.col(time_col).alias("timestamp"))
    return df.select(*cols)


def batch_messages(df: DataFrame, topic: str, batch_id: int | str) -> DataFrame:
    """Rows as messages that can be published again: each one's key names its batch, its payload's hash and which of the batch's
    equal payloads it is. The same batch gives the same keys, whatever the order and partitions of its rows.

    Equal payloads are counted in a first level and dealt numbers after it, so a payload that makes up much of the batch is
    numbered by no single task's window."""
    sent = to_messages(df, topic).groupBy("value", "topic").agg(F.count(F.lit(1)).alias("_n"))
    numbered = sent.select("value", "topic", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n")).alias("_i"))
    key = F.concat_ws("/", F.lit(str(batch_id)), F.sha2("value", 256), F.col("_i").cast("string"))
    return numbered.select(F.encode(key, "UTF-8").alias("key"), "value", "topic")


def distinct_messages(messages: DataFrame) -> DataFrame:
    """One of each message that ``batch_messages`` published, the one of the smallest (partition, offset); messages without a
    key stay. Partial aggregation runs before the shuffle."""
    columns = messages.columns
    keyed = messages.filter("key IS NOT NULL").groupBy("topic", "key").agg(
        F.min_by(F.struct(*columns), F.struct("partition", "offset")).alias("m")).select("m.*")
    return keyed.unionByName(messages.filter("key IS NULL"))


def write_kafka(messages: DataFrame, options: dict[str, str]) -> None:
    """Batch publish (needs the Kafka connector); the broker assigns partitions and offsets."""
    (messages.select("key", "value", "topic").write.format("kafka")
     .options(**{k: v for k, v in options.items() if k.startswith("kafka.")}).save())


def write_message_files(messages: DataFrame, path: str) -> None:
    """File stand-in for a topic: append the Kafka-shaped rows as Parquet."""
    messages.write.mode("append").parquet(path)
