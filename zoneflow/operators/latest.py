"""Latest reading per zone (WN-01) and the one-aggregate latest-state merge (JN-02).

"Latest" is ordered by (Kafka time, partition, offset), newest first, so ties are broken the same
way every run. Rows whose normalised zone is null or blank are dropped before grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow import schemas as S
from zoneflow.operators import parse as P

READINGS = tuple(f"{S.FEED_PREFIX[t]}_reading" for t in S.TOPICS)


def has_zone(col: str = "norm_zone") -> Column:
    return F.col(col).isNotNull() & (F.col(col) != "")


def latest_by_zone(feed: DataFrame, prefix: str, keys: tuple[str, ...] = ("norm_zone",)) -> DataFrame:
    """WN-01: one row per zone, the newest by (kafka_time, partition, offset).

    ``row_number() == 1`` lets Spark put a partial ``WindowGroupLimit`` before the shuffle, so each
    map task sends at most one row per zone; a hot zone costs no more shuffle than a cold one.
    """
    w = Window.partitionBy(*keys).orderBy(
        F.col(f"{prefix}_kafka_time").desc(), F.col(f"{prefix}_kafka_partition").desc(),
        F.col(f"{prefix}_kafka_offset").desc())
    # The zone check is a separate column so the filter stays above the window: a filter on the
    # partition key would be pushed below the parse and parse every JSON payload twice.
    return (feed.withColumn("_zone_ok", has_zone(keys[0]))
            .withColumn("_rn", F.row_number().over(w))
            .filter((F.col("_rn") == 1) & F.col("_zone_ok"))
            .drop("_rn", "_zone_ok"))


def order_key() -> Column:
    return F.struct("kafka_time", "kafka_partition", "kafka_offset")


def newest_raw(keyed: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The newest message of each feed per key, unparsed: ``_raw_<prefix>`` structs (payload and Kafka
    columns), in ONE aggregation. ``keyed`` has the message columns and the keys.

    ``max_by`` skips rows whose ordering is null, so the conditional ordering picks the newest
    message of each topic; a key missing a feed gets null. Partial aggregation runs before the
    shuffle; only the winners' payloads travel.
    """
    raw = F.struct("json_payload", *P.KAFKA_COLS)
    return keyed.groupBy(*keys).agg(
        F.max(has_zone()).alias("_zone_ok"),
        *[F.max_by(raw, F.when(F.col("topic") == t, order_key())).alias(f"_raw_{S.FEED_PREFIX[t]}")
          for t in S.TOPICS])


def latest_readings(messages: DataFrame) -> DataFrame:
    """The newest reading of each feed per zone, as three struct columns (JN-02 / STR-04).

    Only the zone is parsed before the reduction; the winners, three a zone, are parsed after it.
    In a streaming query the aggregate is the keyed state, kept in the checkpoint.
    """
    keyed = messages.withColumn("norm_zone", P.zone_of_payload())
    # As in latest_by_zone, the zone check is aggregated rather than filtered first, so the
    # filter is not pushed below the zone parse (which would parse each payload twice).
    newest = newest_raw(keyed, ("norm_zone",)).filter(F.col("_zone_ok")).drop("_zone_ok")
    return P.parse_newest(newest, ("norm_zone",))


def complete(latest: DataFrame) -> DataFrame:
    """STR-05: zones that have all three feeds."""
    cond = F.lit(True)
    for r in READINGS:
        cond = cond & F.col(r).isNotNull()
    return latest.filter(cond)


def expand_readings(latest: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Flatten the three reading structs into the per-feed columns."""
    return latest.select("norm_zone", *extra, *[f"{r}.*" for r in READINGS])
