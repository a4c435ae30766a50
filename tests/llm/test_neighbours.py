"""Nearest neighbours: exact where all rows are candidates, recall against brute force, copies and odd vectors."""

import math

import numpy as np
from pyspark.sql import functions as F

from zoneflow.llm import catalog, neighbours

def every():
    return F.col("vec_id") % 100 == 0


def brute(ids, vectors, wanted, count=10):
    out = {}
    for q in wanted:
        own = vectors[ids == q][0]
        d = np.sqrt(((vectors - own) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:count]
        out[q] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def found(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def read(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)


def test_query_is_exact_on_a_small_table(spark):
    ids, vectors = read(spark, "sf0.01")
    got = found(catalog.QUERIES["op3_nearest"](spark, "/root/testdata/sf0.01"))
    want = brute(ids, vectors, [i for i in ids if i % 100 == 0])
    assert got.keys() == want.keys()
    for q, rows in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in rows]
        assert np.allclose([s for _, s in got[q]], [s for _, s in rows], rtol=1e-12)


def test_recall_with_buckets_and_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS", 700)  # several buckets a tree, of several parts
    ids, vectors = read(spark, "sf0.1")
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = found(neighbours.nearest(frame, every()))
    want = brute(ids, vectors, [i for i in ids if i % 100 == 0])
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in rows}) for q, rows in want.items())
    assert hits / (10 * len(want)) >= 0.9, hits / (10 * len(want))


def test_copies_odd_vectors_repeats_and_empty_tables(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 4))
    rows = [(i, [float(x) for x in base[i % 60]] if i < 400 else [1.0, 2.0, 3.0, 4.0]) for i in range(1000)]
    rows += [(1000, None), (1001, [0.0] * 4), (1002, [math.nan, 1.0, 1.0, 1.0]), (1003, [None, 1.0, 1.0, 1.0]), (1004, []),
             (1005, [math.inf, 1.0, 1.0, 1.0]), (1006, [1.0, 2.0]), (None, [1.0, 2.0, 3.0, 4.0]), (1100, None), rows[0], rows[500]]
    frame = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<double>, score double")
    got = found(neighbours.nearest(frame, every()))
    ids, vectors = np.arange(1000), np.array([r[1] for r in rows[:1000]])
    assert got == {q: [(i, float(s)) for i, s in v] for q, v in brute(ids, vectors, range(0, 1000, 100)).items()}
    assert neighbours.nearest(frame.limit(0), every()).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (100, [5.0])], "vec_id long, embedding array<float>")
    assert found(neighbours.nearest(few, every())) == {0: [(1, 1.0), (100, 4.0)], 100: [(1, 3.0), (0, 4.0)]}
