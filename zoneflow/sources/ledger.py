"""Offset ledger: scheduled runs that read each message once (SRC-04, STR-08).

Runs with a lookback range read the messages of overlapping ranges again and again. A ledger records which offsets each run read
(one row a topic partition) and keeps the state that the run left (the newest message of each zone and feed); the
next run reads the offsets after them alone, merges them into the state and gives the same documents.

A run counts once its row of offsets is written, which is the last thing it does. A run that failed before is simply
run again: it reads the same range and replaces what the failed one left.
"""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.functions.times import ntz
from zoneflow.operators import parse as P
from zoneflow.operators import unify as U
from zoneflow.session import child_names, path_exists, remove_path
from zoneflow.sinks.carry import CARRY_SCHEMA, newest_messages
from zoneflow.sources.kafka import message_columns

RANGE_DDL = "topic string, `partition` int, start bigint, until bigint, messages bigint"


class OffsetLedger:
    """The runs of one job, at ``path``."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def runs(self, spark: SparkSession) -> list[int]:
        """Finished runs."""
        return sorted(int(n.split("=")[1]) for n in child_names(spark, f"{self.path}/runs")
                      if n.startswith("run=") and path_exists(spark, f"{self.path}/runs/{n}/_SUCCESS"))

    def ranges(self, spark: SparkSession) -> DataFrame:
        """What each finished run read: run, topic, partition, start, until (exclusive), messages."""
        folders = [f"{self.path}/runs/run={r}" for r in self.runs(spark)]
        if not folders:
            return spark.createDataFrame([], f"run bigint, {RANGE_DDL}")
        return (spark.read.schema(f"{RANGE_DDL}, run bigint").option("basePath", f"{self.path}/runs").parquet(*folders)
                .select("run", "topic", "partition", "start", "until", "messages"))

    def next_offsets(self, spark: SparkSession) -> dict[tuple[str, int], int]:
        """The first offset of each topic partition that no run has read (a row a topic partition)."""
        rows = self.ranges(spark).groupBy("topic", "partition").agg(F.max("until").alias("until")).collect()
        return {(r.topic, r.partition): r.until for r in rows}

    def starting_offsets(self, spark: SparkSession) -> str | None:
        """The same as the text of the reader's ``startingOffsets`` option (``lookback_options``); None before the first run."""
        topics: dict[str, dict[str, int]] = {}
        for (topic, partition), until in sorted(self.next_offsets(spark).items()):
            topics.setdefault(topic, {})[str(partition)] = until
        return json.dumps(topics) if topics else None

    def unread(self, messages: DataFrame) -> DataFrame:
        """The messages (with the broker's columns) after what the runs have read: a predicate on topic, partition and offset, which a
        scan of landed messages takes, and with no lower bound for partitions that are new."""
        ends = self.next_offsets(messages.sparkSession)
        if not ends:
            return messages
        known = [(F.col("topic") == t) & (F.col("partition") == p) for t, p in ends]
        after = [k & (F.col("offset") >= until) for k, until in zip(known, ends.values())]
        return messages.filter(reduce(Column.__or__, after) | reduce(Column.__and__, [~k for k in known]))

    def state(self, spark: SparkSession) -> DataFrame:
        """The newest message of each zone and topic after the last finished run, as message columns and ``norm_zone``."""
        runs = self.runs(spark)
        if not runs:
            return spark.createDataFrame([], CARRY_SCHEMA)
        return spark.read.schema(CARRY_SCHEMA).parquet(f"{self.path}/state/run={runs[-1]}")


def ledger_batch(messages: DataFrame, ledger: OffsetLedger, as_of: dt.datetime, write, lookback_minutes: int | None = None,
                 zones: DataFrame | None = None) -> int:
    """STR-08 with a ledger: one run over the messages that no run has read; returns the run's number.

    The documents of complete zones (from the newest readings of all runs, none older than ``lookback_minutes`` if that is
    given) go to ``write(documents, run)``. A run without new messages writes the documents of the kept state.
    """
    spark = messages.sparkSession
    run = max(ledger.runs(spark), default=-1) + 1
    new = ledger.unread(messages)
    # the range is fixed first: what arrives while the run works is the next one's
    ranges = (new.groupBy("topic", "partition").agg(F.min("offset").alias("start"), (F.max("offset") + 1).alias("until"),
                                                    F.count(F.lit(1)).alias("messages")).collect())  # a row a topic partition
    ends = [(F.col("topic") == r.topic) & (F.col("partition") == r.partition) & (F.col("offset") < r.until) for r in ranges]
    new = new.filter(reduce(Column.__or__, ends, F.lit(False)))
    rows = message_columns(new).withColumn("norm_zone", P.zone_of_payload())
    kept = newest_messages(rows.unionByName(ledger.state(spark).select(*rows.columns)))
    state = f"{ledger.path}/state/run={run}"
    kept.select("topic", "json_payload", *P.KAFKA_COLS, "norm_zone").hint("rebalance").write.mode("overwrite").parquet(state)
    current = spark.read.schema(CARRY_SCHEMA).parquet(state)
    if lookback_minutes is not None:
        start = ntz(as_of - dt.timedelta(minutes=lookback_minutes))
        current = current.filter(F.col("kafka_time").between(start, ntz(as_of)))
    write(U.unified_snapshot(current, as_of, zones), run)
    (spark.createDataFrame([tuple(r) for r in ranges], RANGE_DDL).coalesce(1)
     .write.mode("overwrite").parquet(f"{ledger.path}/runs/run={run}"))
    for name in child_names(spark, f"{ledger.path}/state"):
        if int(name.split("=")[1]) < run:
            remove_path(spark, f"{ledger.path}/state/{name}")
    return run
