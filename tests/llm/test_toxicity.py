"""Toxicity: held-out accuracy, the risk estimator's effect, edge cases."""

import random

from pyspark.sql import functions as F

from zoneflow.llm import catalog, toxicity


def corpus(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(40)}x" for _ in range(rng.randrange(5, 60))]
        words = ["".join(rng.choice("bcdfgaeiou") for _ in range(5)) for _ in words]
        toxic = i % 4 == 0
        if toxic:
            words += rng.choices(["scumbag", "idiots", "Moron!"], k=3)
        out.append((" ".join(words), toxic))
    return out


def test_learns_from_positives_and_unlabelled_alone():
    data = corpus(5000, 1)
    positives = [t for t, x in data if x][:1000]
    unlabelled = [t for t, _ in data[2500:]]
    w = toxicity.fit(positives, unlabelled, 0.25)
    test = corpus(400, 9)
    known = toxicity.Weights(w)
    assert sum((toxicity.logit(known, t) >= 0) == x for t, x in test) / len(test) >= 0.95


def test_the_prior_is_estimated_without_clean_labels():
    for every, seed in ((4, 1), (4, 2)):
        data = corpus(6000, seed)
        positives = [t for t, x in data if x][:900]
        unlabelled = [t for t, _ in data[2000:]]
        learnt, kept = [t for i, t in enumerate(positives) if i % toxicity.KEPT], positives[::toxicity.KEPT]
        assert abs(toxicity.estimated_prior(learnt, kept, unlabelled) - 1 / every) < 0.06
    assert toxicity.estimated_prior([], [], ["a"]) == toxicity.FIRST_PRIOR
    known = toxicity.Weights(toxicity.fit(positives, unlabelled))
    test = corpus(400, 9)
    assert sum((toxicity.logit(known, t) >= 0) == x for t, x in test) / len(test) >= 0.95


def test_letters_inside_long_runs_count():
    rng = random.Random(4)

    def clause(toxic):  # a script without spaces: one run of letters
        letters = [rng.choice("bcdfgaeiou") for _ in range(60)]
        if toxic:
            at = rng.randrange(20, 50)
            letters[at:at] = "scumbag"
        return "".join(letters)

    positives = [clause(True) for _ in range(600)]
    unlabelled = [clause(i % 4 == 0) for i in range(2400)]
    known = toxicity.Weights(toxicity.fit(positives, unlabelled, 0.25))
    assert sum((toxicity.logit(known, clause(i % 2 == 0)) >= 0) == (i % 2 == 0) for i in range(400)) >= 380


def test_forward_risk_equals_plain_code():
    """One step of training against the gradient of the risk by differences, in both cases of the estimator."""
    import numpy as np
    pos, unl, prior = ["a b c", "a c d"] * 4, ["b d", "e f a", "c", "d e"] * 4, 0.4
    data = toxicity.Sparse(pos + unl)

    def risk(w):
        g = np.array([w[-1] + sum(v * w[c] for c, v in zip(*row)) for row in data.rows])
        gp, gu = g[: len(pos)], g[len(pos):]
        clean = np.mean(np.log1p(np.exp(gu))) - prior * np.mean(np.log1p(np.exp(gp)))
        return prior * np.mean(np.log1p(np.exp(-gp))), clean

    w = np.zeros(toxicity.FEATURES + 1)
    w[-1] = np.log(prior / (1 - prior))
    trained = toxicity.train(pos, unl, prior, passes=40)
    before, after = sum(risk(w)), risk(trained)
    assert after[0] + max(0, after[1]) < before


def test_nulls_empty_tables_and_clashing_columns(spark):
    rows = [(1, "x y", 7), (2, None, 7), (None, "", 7), (3, "word " * 30_000, 7), (3, "word " * 30_000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0
    assert toxicity.without_toxic(docs, labels).columns == docs.columns


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    got = catalog.QUERIES["op5_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    row = got.where("held_out").join(labels, "doc_id").agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("double")).alias("acc"),
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("recall"),
        F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("false")).first()
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert row.acc >= 0.96 and row.recall >= 0.85 and row.false <= 0.03, row
