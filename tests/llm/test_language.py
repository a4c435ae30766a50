"""Language identification: code lengths against a plain PPM, held-out accuracy, edge cases."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from zoneflow.llm import catalog, language


LEARNT, FR, ES = [i for i in range(10, 99) if zlib.crc32(str(i).encode()) % 5][:3]  # not held out


def plain_length(train, text, symbols):
    """Code length of ``text`` by the counts of ``train``, by recursion on ever shorter contexts."""
    seen = defaultdict(Counter)
    for t in train:
        padded = b"\n" * language.ORDER + t
        for i in range(len(t)):
            for k in range(language.ORDER + 1):
                at = i + language.ORDER
                seen[padded[at - k:at]][padded[at]] += 1

    def p(context, b):
        if context is None:
            return 1 / symbols
        shorter = context[1:] if context else None
        c = seen.get(context)
        if not c or sum(c.values()) < 1:
            return p(shorter, b)
        n, q = sum(c.values()), len(c)
        rest = 1 - sum(p(shorter, x) for x in c)
        if b in c:
            return c[b] / (n + q)
        return q / (n + q) * p(shorter, b) / rest

    padded = b"\n" * language.ORDER + text
    return sum(-math.log(p(padded[i - language.ORDER:i], padded[i])) for i in range(language.ORDER, len(padded)))


def test_code_lengths_equal_plain_ppm(monkeypatch):
    monkeypatch.setattr(language, "LEAST", 1)
    rng = random.Random(4)
    train = {k: ["".join(rng.choice(v) for _ in range(60)).encode() for _ in range(4)] for k, v in {"x": "abcd ", "y": "abde"}.items()}
    model = language.train(train)
    texts = [b"abcd abe", b"ddd  acb", b"a", b""]
    got = language.code_lengths(model, texts)
    for k, name in enumerate(model.languages):
        symbols = len({b for t in train.values() for x in t for b in x} | {10}) + 1
        want = [plain_length(train[name], t, symbols) for t in texts]
        assert np.allclose(got[:, k], want, rtol=2e-3), (got[:, k], want)


def test_probabilities_add_up_to_one():
    model = language.train({"x": [b"some text with words, words and words"] * 3, "y": [b"otra cosa"] * 9})
    base = round(len(model.deepest) ** (1 / language.ORDER))
    sums = np.exp(-model.lengths.astype(float)).reshape(-1, base, 2).sum(axis=1)
    assert np.allclose(sums, 1, atol=5e-3)


def test_edges(spark):
    assert not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in (LEARNT, FR, ES))
    rows = [(1, None, "en", 1), (2, "", "en", 1), (3, "123 ½ --", "fr", 1), (None, "abc def", "en", 1), (5, "abc " * 50_000, None, 1),
            (LEARNT, "the cat and the dog", "en", 1), (LEARNT, "the cat and the dog", "en", 1), (FR, "le chat et le chien", "fr", 1), (ES, "el gato", "es", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = language.identify(docs).collect()
    assert len(got) == 9
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by[1].score == 0
    assert by[LEARNT].lang_pred == "en" and 0 <= by[LEARNT].score <= 1
    assert language.identify(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_null_and_long_texts_take_no_places_of_the_sample(spark):
    keys = [i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 5]
    rng = random.Random(6)
    say = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    fr, es, de = ["le", "chat", "et", "chien", "dans"], ["el", "gato", "y", "perro", "donde"], ["der", "hund", "und", "katze", "wo"]
    rows = [(k, None, "fr") for k in keys[:100]] + [(k, say(fr, 8_000), "fr") for k in keys[100:150]]  # null or long alone, or
    rows += [(k, say(fr, 20), "fr") for k in keys[150:155]] + [(k, say(es, 20), "es") for k in keys[160:200]]  # a few others
    rows += [(k, say(de, 9_000), "de") for k in keys[200:240]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language.learn(docs, per_language=5)
    assert model.languages == ["de", "es", "fr"]
    texts = [say(w, 30).encode() for w in (de, es, fr)]
    assert language.code_lengths(model, texts).argmin(axis=1).tolist() == [0, 1, 2]


def test_chosen_rows_are_those_of_the_smallest_hashes(spark):
    rows = spark.range(30_000).select(F.col("id").alias("key"), F.when(F.col("id") % 100 == 0, "a").otherwise("b").alias("lang"),
                                      (F.col("id") % 7 == 0).alias("long"))
    got = sorted(tuple(r) for r in language.chosen_rows(rows, 50).collect())
    mark = F.xxhash64(F.col("key").cast("string"))
    want = []
    for name in "ab":
        want += [(r.key, name) for r in rows.where(F.col("lang") == name).orderBy("long", mark).limit(50).collect()]
    assert got == sorted(want)


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    got = catalog.QUERIES["op2_language"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    row = got.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")).alias("acc")).first()
    assert got.count() == docs.count() and row.acc >= 0.97, row
