"""Helpers shared by the text operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.session import intermediate_path, remove_path

#: Rows of one Arrow batch handed to Python: whole texts travel, so few rows a batch keep a worker's memory small.
BATCH_ROWS = 256

#: One of so many parts of the labelled rows, by checksum of the id, is held out from learning.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, by a path that only Spark's reader has to understand."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Prepare Python work: bound the rows of an Arrow batch, as whole texts of any length are handed over, and let
    Python workers import this package from where the driver has it (the deployment installs it there on a cluster)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def held_out(key: str = "doc_id") -> Column:
    """True for the rows that no model may learn from: crc32 of the id's text, modulo ``FOLDS``, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def hash_sample(rows: DataFrame, limit: int, key: str = "doc_id") -> DataFrame:
    """At most ``limit`` rows, chosen by the hash of the key alone (the same ones on every run)."""
    return rows.orderBy(F.xxhash64(F.col(key).cast("string")), F.col(key)).limit(limit)


def sample_texts(docs: DataFrame, ids: DataFrame, limit: int, most_bytes: int, key: str = "doc_id",
                 text: str = "text") -> list[tuple]:
    """(key, text, further columns of ``ids``) for at most ``limit`` rows of ``ids``, by key: a bounded sample for the driver.

    ``ids`` has the key and, say, a label; its rows are chosen by the key's hash, so only ``limit`` narrow rows meet the
    documents. Null texts and texts of more than ``most_bytes`` bytes drop out of the sample, repeated keys count once.
    """
    chosen = F.broadcast(hash_sample(ids.dropna(subset=[key]).dropDuplicates([key]), limit, key))  # at most limit rows
    rest = [c for c in ids.columns if c != key]
    rows = (docs.select(key, F.col(text).alias("_text")).join(chosen, key)
            .where(F.octet_length("_text") <= most_bytes).dropDuplicates([key]).select(key, "_text", *rest))
    return sorted((tuple(r) for r in rows.collect()), key=lambda r: r[0])


def written(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written as Parquet in the shared folder and read back: a lineage cut that survives lost executors.

    The folder lies under ``spark.checkpoint.dir``; it is removed by ``forget``, or else when the application ends.
    """
    spark = frame.sparkSession
    path = intermediate_path(spark, name)
    frame.write.parquet(path)
    out = spark.read.schema(frame.schema).parquet(path)
    out.written_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove ``written`` tables that nothing will read any more."""
    for t in tables:
        remove_path(t.sparkSession, t.written_at)


def groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The runs of equal keys in sorted batches, each as one frame."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        change = np.flatnonzero((batch[keys].values[1:] != batch[keys].values[:-1]).any(axis=1)) + 1
        for part in np.split(np.arange(len(batch)), change):
            frame = batch.iloc[part]
            if rest and (frame[keys].values[0] != rest[0][keys].values[0]).any():
                yield pd.concat(rest)
                rest = []
            rest.append(frame)
    if rest:
        yield pd.concat(rest)
