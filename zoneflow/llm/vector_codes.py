"""Vector code compression by member-resident Lloyd rounds.

Vectors of integers are cut into equal parts, and each part is replaced by the number of its nearest codebook entry. The parts live as
members in a table partitioned by (position, entry, salt): a partition owns members of an entry. In a round the owners assign their
resident members anew; only the parts whose entry changes migrate to their new owner in the next shuffle, and the owners sum up
what they then hold. What leaves the owners is one sum a position and entry. The salt, a hash of the part, deals an entry that has
very many members to as many owners as its size asks for.

All arithmetic is on integers and exact: in double precision where every intermediate value is below 2^52, with Python's
integers beyond.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.blocks import carried, carried_kind, join_counted
from zoneflow.llm.common import small_batches, written

#: Equal parts of a vector, entries of a codebook, rounds of learning.
PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: A component x becomes floor(SCALE * x).
SCALE = 256
#: Scaled components beyond this size are cut to it (no 64-bit integer could hold them).
MOST = 1 << 62
#: Members of one owner, about.
OWNER_ROWS = 2048
#: Groups of ids whose smallest members bound the smallest ids of all.
ID_GROUPS = 4096
BATCH = 4096

Codebooks = list[list[list[int]]]  # by position, entry, component


def scaled(vector: Column) -> Column:
    """The components as integers, floor(256 x)."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(F.greatest(
        F.least(x * F.lit(float(SCALE)), F.lit(float(MOST))), F.lit(-float(MOST)))).cast("bigint"))


def is_whole(vector: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    return vector.isNotNull() & F.forall(vector.cast("array<double>"), lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))


def smallest_rows(rows: DataFrame, limit: int) -> list[tuple]:
    """The ``limit`` smallest rows (key, ints) by key (nulls last), then components.

    The smallest keys of ``ID_GROUPS`` groups are aggregated first: the ``limit``-th of them is no less than the key looked
    for, so a few rows remain to be ordered, and no task receives rows of all others.
    """
    groups = (rows.where("key is not null").groupBy(F.pmod(F.xxhash64("key"), F.lit(ID_GROUPS)).alias("g")).agg(F.min("key").alias("key"))
              .orderBy("key").limit(limit).agg(F.max("key").alias("most"), F.count("*").alias("n")).first())
    if groups.n == limit:
        rows = rows.where(F.col("key") <= F.lit(groups.most))
    rows = rows.orderBy(F.col("key").asc_nulls_last(), "ints").limit(limit)
    return [(r.key, list(r.ints)) for r in rows.collect()]


def nearest_entries(parts: np.ndarray, book: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each row of ``parts``; ties go to the lower entry."""
    most = max(int(np.abs(parts).max(initial=0)), max((abs(x) for e in book for x in e), default=0))
    if len(book[0]) * (2 * most) ** 2 < 1 << 52:
        x, c = parts.astype(np.float64), np.array(book, np.float64)
        distance = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
        entry = distance.argmin(axis=1)
        return entry, distance[np.arange(len(x)), entry].astype(np.int64)
    best = [min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book)) for part in parts.tolist()]
    return np.array([k for _, k in best], np.int64), np.array([d for d, _ in best], object)


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.array(rows.tolist(), np.int64).reshape(len(rows), -1)


def first_members(ints: DataFrame, books: Codebooks, salts: int) -> DataFrame:
    """Members (position, entry, salt, part, weight): the parts of all vectors at their first entries. Equal parts of a
    batch are one member with their number as its weight."""
    shared = ints.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            whole = _matrix(batch["ints"])
            cut = whole.reshape(len(whole), len(shared.value), -1)
            for position, book in enumerate(shared.value):
                parts, weight = np.unique(cut[:, position], axis=0, return_counts=True)
                entry, _ = nearest_entries(parts, book)
                yield pd.DataFrame({"position": position, "entry": entry, "part": list(parts), "weight": weight})

    found = ints.select("ints").mapInPandas(run, "position int, entry int, part array<bigint>, weight bigint")
    return found.select("position", "entry", F.pmod(F.xxhash64("part"), F.lit(salts)).cast("int").alias("salt"), "part", "weight")


def reassigned(members: DataFrame, books: Codebooks) -> DataFrame:
    """Members with ``new_entry``, where the codebooks put them now; each row stays where it is."""
    shared = members.sparkSession.sparkContext.broadcast(books)

    @F.pandas_udf("int")
    def entry_of(position: pd.Series, part: pd.Series) -> pd.Series:
        out = np.empty(len(part), np.int64)
        if len(part):
            parts, at = _matrix(part), position.to_numpy()
            for p in np.unique(at):
                here = np.flatnonzero(at == p)
                out[here] = nearest_entries(parts[here], shared.value[p])[0]
        return pd.Series(out)

    return members.withColumn("new_entry", entry_of("position", "part"))


def updated(members: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks whose entries are the floored means of their members; an entry without members stays. The owners' sums
    (one row a position and entry) are all that is collected."""
    size = len(books[0][0])
    big = "decimal(38,0)"
    sums = members.groupBy("position", "entry").agg(F.sum("weight").alias("n"), *[
        F.sum(F.col("part")[i].cast(big) * F.col("weight").cast("decimal(19,0)")).cast(big).alias(f"s{i}") for i in range(size)])
    books = [list(book) for book in books]
    for r in sums.collect():
        books[r.position][r.entry] = [int(r[f"s{i}"]) // r.n for i in range(size)]
    return books


def learnt(ints: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, owner_rows: int = OWNER_ROWS) -> Codebooks:
    """Codebooks after ``rounds`` rounds over all rows of ``ints`` (key, ints), which has one length of vectors."""
    spark = ints.sparkSession
    first = [v for _, v in smallest_rows(ints, entries)]
    size = len(first[0]) // parts
    books = [[v[p * size : (p + 1) * size] for v in first] for p in range(parts)]
    salts = -(-ints.count() // owner_rows)
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    members = written(first_members(ints, books, salts).repartition(owners, "position", "entry", "salt"), "members")
    for turn in range(rounds):
        if turn:
            here = written(reassigned(members, books), "reassigned")
            came = here.where("new_entry <> entry").drop("entry").withColumnRenamed("new_entry", "entry")
            stay = here.where("new_entry = entry").drop("new_entry")
            members = stay.unionByName(came.repartition(owners, "position", "entry", "salt"))
        books = updated(members, books)
    return books


def coded(ints: DataFrame, books: Codebooks) -> DataFrame:
    """(key, label, code, error) of every vector: two hex digits a part, and the squared distances added up."""
    shared = ints.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            whole = _matrix(batch["ints"])
            cut = whole.reshape(len(whole), len(shared.value), -1)
            codes, error = np.empty((len(whole), len(shared.value)), np.uint8), np.zeros(len(whole), object)
            for position, book in enumerate(shared.value):
                entry, distance = nearest_entries(cut[:, position], book)
                codes[:, position] = entry
                error += distance
            yield pd.DataFrame({"key": batch["key"].astype(object), "label": batch["label"].astype(object), "code": [c.tobytes().hex() for c in codes],
                                "error": [min(int(e), (1 << 63) - 1) for e in error]})

    of_key, of_label = (ints.schema[c].dataType.simpleString() for c in ("key", "label"))
    rows = ints.select(carried("key", of_key).alias("key"), carried("label", of_label).alias("label"), "ints").mapInPandas(
        run, f"key {carried_kind(of_key)}, label {carried_kind(of_label)}, code string, error bigint")
    return rows.select(F.col("key").cast(of_key).alias("key"), F.col("label").cast(of_label).alias("label"), "code", "error")


def digest(books: Codebooks) -> str:
    """SHA-256 of all entries' components as decimal numbers, by position, entry and component."""
    return hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, owner_rows: int = OWNER_ROWS) -> DataFrame:
    """One row a vector: ``key``, code, error, label_error (the errors of its label added up) and codebooks_sha256.

    ``entries``: 256 at most. Rows whose vector is null or holds null or non-finite components go. Vectors that are shorter than the
    longest, or whose length is no multiple of ``parts``, count as followed by zeros (an empty vector is all zeros). The first codebooks
    are the parts of the smallest keys; repeated keys count each, ordered by their components, null keys come last. With fewer rows
    than entries there are fewer entries. Null labels are one label. An empty table gives an empty one. Scaled components are cut to
    +-2^62 and errors to 2^63 - 1. Other columns are not read, whatever their names.
    """
    spark = vectors.sparkSession
    small_batches(spark, BATCH)
    own = (vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"), F.col(label).alias("label"))
           .where(is_whole(F.col("vector"))).select("key", "label", scaled(F.col("vector")).alias("ints")))
    longest = own.agg(F.max(F.size("ints"))).first()[0]
    if longest is None:
        return own.select(F.col("key").alias(key), F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"),
                          F.lit(0).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    width = parts * max(-(-longest // parts), 1)
    zeros = F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("ints"))
    own = own.withColumn("ints", F.concat("ints", zeros))
    books = learnt(own, parts, entries, rounds, owner_rows)
    codes = written(coded(own, books), "codes")
    sums = codes.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.col("error").cast("decimal(19,0)")).alias("total"))
    sums = sums.select("label", "n", F.least("total", F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("bigint").alias("label_error"))
    rows = join_counted(codes, sums, "label", "n", codes.count())
    return rows.select(F.col("key").alias(key), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _twin(vectors: str, parts: int, entries: int, rounds: int) -> str:
    steps = [f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM {vectors} WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (SELECT vec_id, label, p, list_slice(ints, p * (len(ints) // {parts}) + 1, (p + 1) * (len(ints) // {parts})) AS v
  FROM kept, range({parts}) AS r(p)),
book0 AS (SELECT p, CAST(row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS BIGINT) AS e, v FROM part QUALIFY e < {entries})"""]
    for turn in range(rounds + 1):
        steps.append(f"""near{turn} AS (SELECT a.vec_id, a.label, a.p, min({{'d': list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))),
    'e': b.e}}) AS m, any_value(a.v) AS v FROM part a JOIN book{turn} b ON a.p = b.p GROUP BY a.vec_id, a.label, a.p)""")
        if turn < rounds:
            steps.append(f"""sum{turn} AS (SELECT p, m.e AS e, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS x
  FROM near{turn}, range(1, 1025) AS r(i) WHERE i <= len(v) GROUP BY p, m.e, i),
mean{turn} AS (SELECT p, e, list(x ORDER BY i) AS v FROM sum{turn} GROUP BY p, e),
book{turn + 1} AS (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{turn} b LEFT JOIN mean{turn} m ON b.p = m.p AND b.e = m.e)""")
    last = rounds
    return f"""WITH {", ".join(steps)},
coded AS (SELECT vec_id, label, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM near{last} GROUP BY vec_id, label),
shown AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) AS s FROM
  (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM book{last}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256 FROM coded, shown"""


#: DuckDB: the same result by plain joins of all parts with all entries.
SQL = _twin("embeddings", PARTS, ENTRIES, ROUNDS)
