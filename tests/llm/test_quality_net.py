"""Quality network: gradients against differences, batches against single texts, held-out accuracy, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from zoneflow.llm import catalog
from zoneflow.llm import quality_net as q


def loss(net, texts, labels):
    g = q.logits(net, texts)
    return float(np.mean(np.logaddexp(0, g) - labels * g))


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 110, n).astype(np.uint8)) for n in (5, 300, 129, 700)]
    labels = np.array([0, 1, 1, 0], np.float32)
    net = {k: v.astype(np.float64) for k, v in q.fresh(1).items()}
    rows = [q.blocks_of(t) for t in texts]
    d = q.gradients(net, np.vstack(rows), np.repeat(np.arange(4), [len(r) for r in rows]), labels)
    for name, w in net.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in w.shape)
            if name == "bytes":
                at = (int(rng.integers(97, 110)), at[1])
            keep = w[at]
            w[at] = keep + 1e-4
            up = loss(net, texts, labels)
            w[at] = keep - 1e-4
            down = loss(net, texts, labels)
            w[at] = keep
            assert abs((up - down) / 2e-4 - d[name][at]) < 2e-3, name


def test_scores_do_not_depend_on_the_batch_and_cover_whole_texts():
    net, rng = q.fresh(2), np.random.default_rng(1)
    texts = [b"", b"a", b"x" * 128, b"y" * 129, bytes(rng.integers(32, 120, 400_000).astype(np.uint8))]
    together = q.logits(net, texts)
    assert np.allclose(together, [q.logits(net, [t])[0] for t in texts], atol=1e-5)
    longer = texts[-1][:-200] + b"\xff" * 200
    assert q.logits(net, [longer])[0] != together[-1]


def test_edges(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "abc", 1), (3, "abc", 1), (3, "abc", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, predicted int")
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 0)], "doc_id long, quality int")
    got = q.classify(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert q.classify(docs.limit(0), labels.limit(0)).count() == 0


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    got = catalog.QUERIES["op4_quality"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    row = got.where("held_out").join(labels, "doc_id").agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("acc"),
        F.avg(F.when(F.col("quality") == 1, F.col("predicted"))).alias("kept")).first()
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert row.acc >= 0.97 and row.kept >= 0.98, row
