"""Mixing sources to target weights by hash-threshold histograms.

A source of size S (words) with target T takes every document floor(T / S) times, and the documents below a hash
threshold once more. The threshold comes from nested histograms: words by source and hash bucket give the bucket in which
the budget ends, and only that bucket's rows are counted again in finer buckets, until it holds one row (or rows of one
hash). Nothing is sorted, and reruns agree as the hash is of the key alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.llm.common import written

#: Fixed value: what counts as a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, repeating; the mix's size as a share of all; copies of a document at most.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Bits of the hash, and bits refined by one histogram.
BITS, STEP = 60, 10


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def hash_of(key: Column, text: Column) -> Column:
    """60 bits of the MD5 of the key's text; of a null key, of the row's text."""
    digest = F.md5(F.coalesce(key.cast("string"), text, F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint")


def targets(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) of rows (source, size), one row a source.

    A target is weight times a level, or ``most`` times the source's size where that is less. In the order of the ratio at
    which sources reach that cap, the level is that of the first source that stays below its own cap when all before it
    are capped. Only one row a source is windowed.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1)
    weighed = totals.withColumn("weight", weight).withColumn("ratio", most * F.col("source_size") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(whole) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after)
    leveled = weighed.withColumn("level", level).withColumn("open", F.col("level") <= F.col("ratio"))
    # the first open source's level holds for it and all after it; capped ones have theirs above their ratio
    first = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(whole)
    return leveled.select("source", "source_size", F.least(
        (most * F.col("source_size")).cast("double"), F.coalesce(F.col("weight") * first, (most * F.col("source_size")).cast("double"))).alias("target"))


def plan(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target, times, below) of rows (source, size, h): every document is taken ``times`` times,
    and those with a hash below ``below`` once more."""
    state = targets(sized, weights, share, most)
    times = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("bigint")
    state = state.withColumn("times", times).withColumn("left", F.col("target") - F.col("times") * F.col("source_size"))
    state = written(state.select("*", F.lit(0).cast("bigint").alias("lo"), F.lit(1 << BITS).cast("bigint").alias("hi"),
                                 F.col("source_size").alias("words"), F.lit(2).cast("bigint").alias("rows")), "mix")
    inside, shift = sized.select("source", "size", "h"), BITS
    while shift > 0:
        shift -= STEP
        width = 1 << shift
        counted = inside.groupBy("source", F.expr(f"shiftright(h, {shift})").alias("bucket")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
        upto = counted.select(F.col("source").alias("s"), "bucket", F.col("words").alias("w"), F.col("rows").alias("r"),
                              F.sum("words").over(Window.partitionBy("source").orderBy("bucket")).alias("upto"))
        found = upto.join(state.select("source", "left"), F.col("s").eqNullSafe(F.col("source"))).where(
            (F.col("upto") > F.col("left")) & (F.col("upto") - F.col("w") <= F.col("left")))
        edge = found.select("s", (F.col("bucket") * width).alias("new_lo"), ((F.col("bucket") + 1) * width).alias("new_hi"),
                            (F.col("left") - (F.col("upto") - F.col("w"))).alias("new_left"),
                            F.col("w").alias("new_words"), F.col("r").alias("new_rows"))
        state = written(state.join(edge, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "target", "times",
            *[F.coalesce(f"new_{c}", c).alias(c) for c in ("left", "lo", "hi", "words", "rows")]), "mix")
        todo = state.where("rows > 1 AND source_size > 0").select(F.col("source").alias("s"), "lo", "hi")
        if shift == 0 or todo.isEmpty():
            break
        inside = written(inside.join(todo, F.col("source").eqNullSafe(F.col("s"))).where("h >= lo AND h < hi")
                         .select("source", "size", "h"), "mix_rows")
    # what is left in the last bucket is one document, or rows of one hash: taken if that comes nearer to the target
    nearer = (F.col("left") > 0) & (2 * F.col("left") >= F.col("words"))
    return state.select("source", "source_size", "target", "times", F.when(nearer, F.col("hi")).otherwise(F.col("lo")).alias("below"))


def copies(h: Column) -> Column:
    """How many times the plan takes a row of hash ``h`` that was joined to its source's plan."""
    return F.col("times") + F.when(h < F.col("below"), F.lit(1)).otherwise(F.lit(0))


def sizes(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """(key, source, size, h) of documents, written once: all histograms and the result read these narrow rows."""
    return written(docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), size_of(F.col(text)).alias("size"),
                               hash_of(F.col(key), F.col(text)).alias("h")), "sizes")


def mix_report(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
               weights: tuple = WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row a document: ``key``, size, source_size, target (both of its source) and taken, the words the mix takes.

    Null text has size 0, and so has a text without words; nothing of them is taken. A null source is a source of its
    own, the last. Rows of one key (repeated rows, or null keys of equal text) have one hash and are taken together. A
    source without words has target 0. Other columns are not read. An empty table gives no rows.
    """
    sized = sizes(docs, key, text, source)
    by_source = plan(sized, weights, share).withColumnRenamed("source", "s")
    return sized.join(by_source, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("key").alias(key), "size", "source_size", "target", (F.col("size") * copies(F.col("h"))).alias("taken"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                    weights: tuple = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, each as often as the plan takes it (see ``mix_report``)."""
    by_source = plan(sizes(docs, key, text, source), weights, share).select(F.col("source").alias("s"), "times", "below")
    packed = docs.select(F.struct("*").alias("doc"), F.col(source).cast("string").alias("own"), size_of(F.col(text)).alias("size"),
                         hash_of(F.col(key), F.col(text)).alias("h"))  # so that no column of documents clashes with the plan's
    taken = packed.join(by_source, F.col("own").eqNullSafe(F.col("s"))).select(
        "doc", F.when(F.col("size") > 0, copies(F.col("h"))).otherwise(0).cast("int").alias("taken"))
    return taken.where("taken > 0").select("doc", F.explode(F.array_repeat(F.lit(1), F.col("taken")))).select("doc.*")


#: DuckDB's form of ``mix_report`` over documents: within a source the histograms find where the running total of words,
#: in the order of the hash, passes the budget.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 15))::BIGINT AS h FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM totals),
leveled AS (
  SELECT *, 2 * source_size / weight AS ratio,
    (1.5::DOUBLE * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY 2 * source_size / weight, source ASC NULLS LAST)),
targets AS (
  SELECT source, source_size, least(2.0 * source_size, coalesce(weight * (SELECT min_by(level, ratio) FROM leveled WHERE level <= ratio), 2.0 * source_size))::DOUBLE AS target
  FROM leveled),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(2, floor(target / source_size))::BIGINT ELSE 0 END AS times FROM targets),
grouped AS (
  SELECT source, h, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto FROM sized GROUP BY source, h),
extra AS (
  SELECT g.source, g.h, upto <= target - times * source_size
      OR (upto - words <= target - times * source_size AND target - times * source_size - (upto - words) > 0
          AND 2 * (target - times * source_size - (upto - words)) >= words) AS more
  FROM grouped g JOIN planned p ON g.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (size * (times + CASE WHEN more THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
JOIN extra e ON s.source IS NOT DISTINCT FROM e.source AND s.h = e.h
"""
