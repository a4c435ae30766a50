"""Helpers of the operators that hand whole texts or blocks of them to Python: batches bounded by bytes, and joins with hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm.common import small_batches

#: Bytes of one Arrow batch handed to Python; a longer text is a batch of its own.
BATCH_BYTES = 16 << 20
#: A key that has more than one in so many of all rows is hot. There are fewer hot keys than this, whatever the data.
HOT_SHARE = 1000


def text_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound the rows and the bytes of an Arrow batch, as texts may be of any length."""
    small_batches(spark, rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def chosen(ids: DataFrame, limit: int, key: str) -> DataFrame:
    """The ``limit`` rows of ``ids`` (different keys) whose keys have the smallest hashes: the same ones on every run.

    A bound on the hash that leaves about twice as many rows comes first, so that what is ordered is small and no task
    receives rows of all others. The bound is raised while it leaves too few."""
    mark, total = F.xxhash64(F.col(key).cast("string")), ids.count()
    share = 2 * limit / total if total else 1.0
    few = ids
    while share < 0.5:
        few = ids.where(mark <= F.lit(int(share * 2.0**64) - (1 << 63)))
        if few.count() >= limit:
            break
        share, few = 2 * share, ids
    return few.orderBy(mark, F.col(key)).limit(limit)


def chosen_texts(docs: DataFrame, ids: DataFrame, limit: int, most_bytes: int, key: str, text: str) -> DataFrame:
    """(key, text) of at most ``limit`` keys of ``ids``, chosen by their hashes among all keys that are not null; of rows that
    repeat a key the smallest text counts. Null texts and texts of more than ``most_bytes`` bytes drop out."""
    keys = F.broadcast(chosen(ids.select(F.col(key).alias("key")).dropna().distinct(), limit, "key"))  # at most limit rows
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.octet_length("text") <= most_bytes)
    return texts.join(keys, "key").groupBy("key").agg(F.min("text").alias("text"))


def carried(column: str, kind: str) -> Column:
    """A key for its way through pandas, which makes floats of whole numbers next to nulls: as text, unless it is text or bytes.
    Cast back to ``kind`` it is what it was."""
    return F.col(column) if kind in ("string", "binary") else F.col(column).cast("string")


def carried_kind(kind: str) -> str:
    return kind if kind in ("string", "binary") else "string"


def join_counted(rows: DataFrame, counted: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``counted`` (one row a key; ``count``: how many of the ``total`` rows have the key).

    Rows of hot keys meet them by a broadcast of fewer than ``HOT_SHARE`` rows, as no more keys can have that share; the
    others by a shuffle in which no key has more than that share. Null keys are keys like any other. Rows without a
    counterpart go. ``rows`` is read twice, so it should be a written table.
    """
    hot = counted.where(F.col(count) * HOT_SHARE > total)
    cold = counted.where(F.col(count) * HOT_SHARE <= total)
    names = [c for c in counted.columns if c != key]

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed(key, "_other")
        return left.join(right, left[key].eqNullSafe(right["_other"])).select(*left.columns, *names)

    narrow = F.broadcast(hot.select(F.col(key).alias("_hot")))
    rest = rows.join(narrow, rows[key].eqNullSafe(narrow["_hot"]), "left_anti")
    return meet(rows, F.broadcast(hot)).unionByName(meet(rest, cold))
