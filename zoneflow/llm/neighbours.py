"""Approximate nearest neighbours by a hash-prefix forest.

Every vector has one long hash string a tree: a bit for each random hyperplane. A tree's hyperplanes are orthogonal, as far
as there are dimensions, and pass through the median of a bounded sample. A tree is kept as sorted arrays of hash strings. A query descends each tree to the vectors with the longest common
prefix; then all trees ascend together, one bit at a time, until the vectors that share so long a prefix, summed over the
trees, are enough candidates. Candidates are ranked by exact distance on the original vectors.

Spark deals out the arrays: rows of a tree go to buckets by the first bits of their hash, and buckets that hold more than
``ROWS`` rows are dealt into parts. Counts of common prefixes add up over any parts, so both steps (counting by prefix
length, then ranking at the length found) are one shuffle of rows to parts, with the queries sent to the parts they need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.llm.common import groups, hash_sample, small_batches, written

#: Trees, bits of a hash string, rows of a sorted array.
TREES, BITS, ROWS = 48, 48, 16_384
#: Vectors of the sample that places the hyperplanes.
SAMPLE = 10_000
#: Candidates summed over the trees: a share of the indexed rows, and a number at least. The share is what isotropic vectors
#: need for a recall of 0.95 and more; clustered ones do with far less.
SHARE, LEAST = 0.8, 2000
NEAREST = 10


def takes_part(vector: Column) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def hashes(vectors: np.ndarray, planes: np.ndarray, medians: np.ndarray, trees: int) -> np.ndarray:
    """(vector, tree): hash strings as integers, the first bit the highest."""
    out = np.empty((len(vectors), trees), np.int64)
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for t in range(trees):
        bits = vectors @ planes[t] > medians[t]
        out[:, t] = bits @ weights
    return out


def search_counts(frame: pd.DataFrame) -> pd.DataFrame:
    """For each query of a part: how many rows share a prefix of 0, 1, ... BITS bits with it."""
    rows, queries = np.sort(frame.loc[frame["kind"] == 0, "hash"].values), frame[frame["kind"] == 1]
    out = np.empty((len(queries), BITS + 1), np.int64)
    wanted = queries["hash"].values
    for n in range(BITS + 1):  # descent in all queries at once: the array's range that shares n bits
        low = (wanted >> (BITS - n)) << (BITS - n)
        out[:, n] = np.searchsorted(rows, low + (1 << (BITS - n))) - np.searchsorted(rows, low)
    return pd.DataFrame({"query": queries["id"].values, "counts": list(out)})


def search_rows(frame: pd.DataFrame, count: int) -> pd.DataFrame:
    """For each query of a part: the nearest of the rows that share ``level`` bits with it."""
    rows, queries = frame[frame["kind"] == 0].sort_values("hash"), frame[frame["kind"] == 1]
    order, ids = rows["hash"].values, rows["id"].values
    out: list[tuple] = []
    if len(rows):
        vectors = matrix(rows["vector"])
        for query, h, level, vector in zip(queries["id"], queries["hash"], queries["level"], queries["vector"], strict=True):
            low = (int(h) >> (BITS - int(level))) << (BITS - int(level))
            a, b = np.searchsorted(order, [low, low + (1 << (BITS - int(level)))])
            if a < b:
                difference = vectors[a:b] - np.asarray(vector, np.float64)
                score = np.sqrt((difference * difference).sum(axis=1))
                best = np.arange(b - a)
                if b - a > count:  # all that are as near as the last one, then the smaller ids of these
                    best = np.flatnonzero(score <= np.partition(score, count - 1)[count - 1])
                best = best[np.lexsort((ids[a:b][best], score[best]))][:count]
                out += [(query, i, s) for i, s in zip(ids[a:b][best], score[best], strict=True)]
    return pd.DataFrame(out, columns=["query", "vec_id", "score"]).astype({"query": "int64", "vec_id": "int64", "score": "float64"})


def nearest(rows: DataFrame, queries: Column, count: int = NEAREST, key: str = "vec_id", vector: str = "embedding",
            trees: int = TREES, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``queries`` holds for, its ``count`` nearest others, by Euclidean
    distance in double precision, ties to the smaller id.

    Null, empty and zero vectors, vectors with null or non-finite components, vectors of another length than most, and
    rows without a key take no part, as query or candidate. A row that occurs again with the same key and vector counts
    once. Copies of one vector: only the ``count`` + 1 smallest keys of it can be in a result, so only these are indexed,
    and equal queries are searched once; however many copies there are, results are whole. Other columns are not read. An
    empty table gives no rows.
    """
    spark = rows.sparkSession
    small_batches(spark, 4096)
    valid = rows.where(F.col(key).isNotNull() & takes_part(F.col(vector))).select(
        F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"))
    length = valid.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if length is None:
        return spark.createDataFrame([], schema)
    valid = valid.where(F.size("vector") == length.n)
    kept = written(valid.distinct().withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("id")))
                   .where(F.col("place") <= count + 1).select("id", "vector"), "vectors")
    asking = written(valid.where("asks").select("id", "vector").distinct(), "queries")
    asked = asking.groupBy("vector").agg(F.min("id").alias("query"))
    total = kept.count()

    sample = matrix(pd.Series([r.vector for r in hash_sample(kept, SAMPLE, "id").select("vector").collect()]))
    rng = np.random.default_rng(0)
    turns = -(-BITS // length.n)
    planes = np.stack([np.hstack([np.linalg.qr(rng.standard_normal((length.n, length.n)))[0] for _ in range(turns)])[:, :BITS]
                       for _ in range(trees)])
    medians = np.stack([np.median(sample @ planes[t], axis=0) for t in range(trees)])
    shared = spark.sparkContext.broadcast((planes, medians))  # trees x BITS hyperplanes

    def hashed(frame: DataFrame, name: str) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield pd.DataFrame({"id": batch["id"], "vector": batch["vector"],
                                        "hashes": list(hashes(matrix(batch["vector"]), *shared.value, trees))})

        kind = frame.schema["vector"].dataType.simpleString()
        return written(frame.select("id", "vector").mapInPandas(run, f"id bigint, vector {kind}, hashes array<bigint>"), name)

    index = hashed(kept, "index")
    searched = hashed(asked.withColumnRenamed("query", "id"), "searched")

    # buckets by the first bits, so that they hold ROWS rows on average; parts of fuller ones
    first = max(0, min(BITS, int(np.ceil(np.log2(max(1, total / ROWS))))))
    entries = index.select("id", "vector", F.posexplode("hashes").alias("tree", "hash")).withColumn("bucket", F.expr(f"shiftright(hash, {BITS - first})"))
    asks = searched.select("id", "vector", F.posexplode("hashes").alias("tree", "hash"))
    buckets = written(entries.groupBy("tree", "bucket").agg(F.count(F.lit(1)).alias("rows")), "buckets")
    parts = buckets.select("tree", "bucket", F.ceil(F.col("rows") / ROWS).cast("int").alias("parts"))
    dealt = entries.join(parts, ["tree", "bucket"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))

    def asked_of(bucketed: DataFrame, *columns: str) -> DataFrame:
        return bucketed.join(parts, ["tree", "bucket"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
            "tree", "bucket", "part", F.lit(1).alias("kind"), "id", "hash", *columns)

    def by_part(frame: DataFrame, work, schema: str) -> DataFrame:
        keys = ["tree", "bucket", "part"]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for group in groups(batches, keys):
                if (group["kind"] == 1).any():
                    yield work(group)

        # a given number: a part costs far more than its bytes tell, so tasks are not to be merged by bytes
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return frame.repartition(tasks, *keys).sortWithinPartitions(*keys, "kind").mapInPandas(run, schema)

    # descent: rows that share a prefix of each length from the bucket's on; shorter ones from the buckets' counts
    own = asks.withColumn("bucket", F.expr(f"shiftright(hash, {BITS - first})"))
    counted = by_part(dealt.select("tree", "bucket", "part", F.lit(0).alias("kind"), "id", "hash").unionByName(asked_of(own)),
                      search_counts, "query bigint, counts array<bigint>")
    levels = counted.select("query", F.posexplode("counts").alias("level", "n")).where(F.col("level") >= first)
    if first:
        shorter = F.explode(F.sequence(F.lit(0), F.lit(first - 1)))
        prefix = F.expr(f"shiftright(bucket, {first} - level)")
        above = buckets.withColumn("level", shorter).groupBy("tree", "level", prefix.alias("prefix")).agg(F.sum("rows").alias("n"))
        levels = levels.unionByName(own.withColumn("level", shorter).withColumn("prefix", prefix).join(above, ["tree", "level", "prefix"])
                                    .select(F.col("id").alias("query"), "level", "n"))
    enough = max(least, int(share * total))
    # ascent of all trees together: the longest prefix with enough candidates, or none of all if there are not so many
    level = levels.groupBy("query", "level").agg(F.sum("n").alias("n")).where(F.col("n") >= enough).groupBy("query").agg(F.max("level").alias("level"))
    leveled = written(asks.join(level.withColumnRenamed("query", "id"), "id", "left").select(
        "id", "vector", "tree", "hash", F.coalesce("level", F.lit(0)).alias("level")), "levels")
    inside = leveled.where(F.col("level") >= first).withColumn("bucket", F.expr(f"shiftright(hash, {BITS - first})"))
    if first:
        wide = buckets.select("tree", "bucket", shorter.alias("level")).withColumn("prefix", prefix)
        outside = leveled.where(F.col("level") < first).withColumn("prefix", F.expr(f"shiftright(hash, {BITS} - level)"))
        inside = inside.unionByName(outside.join(wide, ["tree", "level", "prefix"]).drop("prefix"))
    found = by_part(dealt.select("tree", "bucket", "part", F.lit(0).alias("kind"), "id", "hash", F.lit(0).alias("level"), "vector")
                    .unionByName(asked_of(inside, "level", "vector")),
                    lambda g: search_rows(g, count + 1), "query bigint, vec_id bigint, score double")
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    best = found.distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= count + 1).drop("place")
    members = asking.join(asked, "vector").select(F.col("id").alias("query_id"), "query")
    others = members.join(best, "query").where(F.col("vec_id") != F.col("query_id"))
    last = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return others.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")
