"""Zone dimension lookups (JN-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StringType, StructField,
                               StructType)

from zoneflow import schemas as S

ZONE_DIM_SCHEMA = StructType([
    StructField("zone_name", StringType(), False),
    StructField("zone_lat", DoubleType(), False),
    StructField("zone_lon", DoubleType(), False),
    StructField("aqi_modifier", DoubleType(), False),
    StructField("free_flow", IntegerType(), False),
    StructField("rush_hours", ArrayType(IntegerType()), False),
])


def zone_dimension(spark: SparkSession) -> DataFrame:
    """The zone dimension as a tiny DataFrame (five rows, fixed)."""
    return spark.createDataFrame([(n, la, lo, m, ff, list(r)) for n, la, lo, m, ff, r in S.ZONES],
                                 ZONE_DIM_SCHEMA)


def with_zone_attributes(df: DataFrame, zones: DataFrame, zone_col: str = "zone_name") -> DataFrame:
    """JN-04: attach coordinates, modifier, free-flow speed and rush hours by zone name.

    A left join: a row of an unknown zone stays, with null attributes. The join strategy is
    Spark's own, by the dimension's bytes.
    """
    if zone_col != "zone_name":
        df = df.withColumnRenamed(zone_col, "zone_name")
    return df.join(zones, "zone_name", "left")


def unmatched_zones(df: DataFrame, zones: DataFrame, zone_col: str = "zone_name") -> DataFrame:
    """Rows by zone name that the dimension lacks (null names included)."""
    named = zones.select(F.col("zone_name").alias("_known"))
    return (df.join(named, F.col(zone_col) == F.col("_known"), "left_anti")
            .groupBy(F.col(zone_col).alias("zone_name")).agg(F.count(F.lit(1)).alias("readings")))
