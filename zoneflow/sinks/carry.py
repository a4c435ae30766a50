"""Carry-in tables (JN-03): the newest message of each feed and zone before a boundary in time.

A bounded replay needs, besides the messages of its range, only the state that older ones left. The table
keeps that state at boundaries, as messages: one row a zone and topic, the newest one of its past. A run extends
it from its newest boundary, so it reads the messages since then and never the whole past; a replay reads the newest boundary
before its range and the messages from there on.

Each boundary is one folder, which counts once it is complete. Late messages are merged into the boundaries after
their time (``amend``) as a new version of these folders; the newest complete version is read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.functions.times import ntz
from zoneflow.operators import latest as L
from zoneflow.operators import parse as P
from zoneflow.session import child_names, path_exists, remove_path

#: The message columns, and the zone that the payload names.
CARRY_SCHEMA = ("topic string, json_payload string, kafka_time timestamp_ntz, kafka_partition int, kafka_offset bigint, "
                "norm_zone string")
_NAME = "%Y%m%dT%H%M%S%f"


def newest_messages(messages: DataFrame, keys: tuple[str, ...] = ("norm_zone", "topic")) -> DataFrame:
    """The newest message of every zone and topic, as a message again (rows without a zone go).

    One aggregation with a partial step before its shuffle, so a map task sends one row a zone and topic."""
    raw = F.struct("json_payload", *P.KAFKA_COLS)
    newest = messages.groupBy(*keys).agg(F.max(L.has_zone()).alias("_zone_ok"), F.max_by(raw, L.order_key()).alias("_raw"))
    return newest.filter("_zone_ok").select("topic", "_raw.*", "norm_zone")


class CarryTable:
    """The boundaries of one message source, at ``path``."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _versions(self, spark: SparkSession) -> Iterator[tuple[dt.datetime, int, str]]:
        """(boundary, version, folder) of every complete folder, in this order."""
        for boundary in child_names(spark, self.path):
            for version in child_names(spark, f"{self.path}/{boundary}"):
                folder = f"{self.path}/{boundary}/{version}"
                if path_exists(spark, f"{folder}/_SUCCESS"):
                    yield dt.datetime.strptime(boundary.split("=")[1], _NAME), int(version.split("=")[1]), folder

    def boundaries(self, spark: SparkSession) -> list[dt.datetime]:
        return sorted({b for b, _, _ in self._versions(spark)})

    def newest_before(self, spark: SparkSession, upto: dt.datetime) -> dt.datetime | None:
        """The newest boundary at or before a time."""
        return max((b for b in self.boundaries(spark) if b <= upto), default=None)

    def read(self, spark: SparkSession, boundary: dt.datetime) -> DataFrame:
        """The newest messages before ``boundary``: message columns and ``norm_zone``."""
        folder = max((v, f) for b, v, f in self._versions(spark) if b == boundary)[1]
        return spark.read.schema(CARRY_SCHEMA).parquet(folder)

    def _write(self, spark: SparkSession, rows: DataFrame, boundary: dt.datetime) -> None:
        at = f"{self.path}/boundary={boundary.strftime(_NAME)}"
        version = 1 + max((int(n.split("=")[1]) for n in child_names(spark, at)), default=-1)
        # a row a zone and topic; clustered so that few zones make few files and many zones many
        rows.select("topic", "json_payload", *P.KAFKA_COLS, "norm_zone").hint("rebalance").write.parquet(f"{at}/version={version}")

    def extend(self, messages: DataFrame, boundary: dt.datetime) -> None:
        """Add ``boundary``: the state of the newest boundary before it, merged with the messages since. ``messages`` are message
        columns (``sources.kafka.message_columns``); only those from the one boundary to the other are read."""
        spark = messages.sparkSession
        start = self.newest_before(spark, boundary)
        if start == boundary:
            return
        new = messages.filter(F.col("kafka_time") < ntz(boundary))
        if start is not None:
            new = new.filter(F.col("kafka_time") >= ntz(start))
        rows = new.withColumn("norm_zone", P.zone_of_payload())
        if start is not None:
            rows = rows.unionByName(self.read(spark, start).select(*rows.columns))
        self._write(spark, newest_messages(rows), boundary)

    def amend(self, late: DataFrame) -> None:
        """Merge messages that came after boundaries later than their time had been written."""
        spark = late.sparkSession
        oldest = late.agg(F.min("kafka_time")).first()[0]
        if oldest is None:
            return
        late = late.withColumn("norm_zone", P.zone_of_payload())
        for boundary in self.boundaries(spark):
            if boundary > oldest:
                rows = late.filter(F.col("kafka_time") < ntz(boundary))
                self._write(spark, newest_messages(rows.unionByName(self.read(spark, boundary).select(*rows.columns))), boundary)

    def forget_before(self, spark: SparkSession, boundary: dt.datetime) -> None:
        """Remove the boundaries before a kept one, and versions that newer ones replace."""
        kept = {}
        for b, v, folder in sorted(self._versions(spark)):
            if b >= boundary:
                if b in kept:
                    remove_path(spark, kept[b])
                kept[b] = folder
        if boundary in kept:
            for b in self.boundaries(spark):
                if b < boundary:
                    remove_path(spark, f"{self.path}/boundary={b.strftime(_NAME)}")

    def messages_since(self, messages: DataFrame, time: dt.datetime) -> DataFrame:
        """Messages that give the same newest reading at any time from ``time`` on as ``messages`` do: the carried ones, and those
        since the newest boundary at or before ``time`` (all, if there is none)."""
        spark = messages.sparkSession
        start = self.newest_before(spark, time)
        if start is None:
            return messages
        # the carried rows keep their own (older) times: the replay counts them into its first state
        return (messages.filter(F.col("kafka_time") >= ntz(start))
                .unionByName(self.read(spark, start).select(*messages.columns)))
