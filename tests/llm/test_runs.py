"""Periodic runs against a plain scan of all periods."""

from __future__ import annotations

import hashlib
import random
import time
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from zoneflow.llm import catalog
from zoneflow.llm.runs import runs_of_texts, word_runs

SF = "/root/testdata/sf0.001"


def plain_runs(words, least=12):
    """Every maximal stretch of every period; stretches that have a smaller period too go."""
    stretches = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, 2 * q):
                stretches.append((start, i - start + q, q))
    least_period = {}
    for s, n, q in stretches:
        least_period[s, n] = min(q, least_period.get((s, n), q))
    return sorted(((s, n, q) for (s, n), q in least_period.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    h, n = crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    digest = lambda b: hashlib.sha256(b).hexdigest()
    shown = digest("".join("%d,%d,%d\n" % r for r in runs).encode())
    kept = digest(b" ".join(w for i, w in enumerate(words) if i not in gone))
    if not runs:
        return doc_id, 0, None, None, None, None, shown, kept
    s, m, q = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[0]
    return doc_id, len(runs), s, m, q, 1000 * m // q, shown, kept


def test_runs_of_random_words_equal_a_plain_scan():
    rnd = random.Random(5)
    texts = []
    for _ in range(1500):
        letters = rnd.choice([1, 2, 3, 6])
        words = [rnd.randrange(letters) for _ in range(rnd.randint(0, 50))]
        unit = [rnd.randrange(letters) for _ in range(rnd.randint(1, 9))]
        at = rnd.randint(0, len(words))
        words = words[:at] + unit * rnd.randint(0, 6) + words[at:]
        texts.append([b"%d" % w for w in words])
    for least in (2, 5, 12):
        assert runs_of_texts(texts, least) == [plain_runs(t, least) for t in texts]


def test_query_equals_a_plain_scan(spark):
    got = sorted(tuple(r) for r in catalog.QUERIES["op13_runs"](spark, SF).collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted(plain_row(*d) for d in docs)
    assert sum(r[1] > 0 for r in got) > 10


@pytest.mark.parametrize("words", [[b"a"] * 60_000, [b"a", b"b"] * 30_000,
                                   [w for i in range(200) for w in [b"x%d" % (i % 7)] + [b"a"] * 200],
                                   [w for i in range(8_000) for w in [b"%d" % i] + b"one phrase of seven words comes again".split()]],
                         ids=["one word", "two words", "runs in a run", "a phrase"])
def test_very_repetitive_texts_stay_near_linear(words):
    start = time.perf_counter()
    runs = runs_of_texts([words])[0]
    assert time.perf_counter() - start < 30
    if len(set(words)) < 3:
        assert runs == [(0, len(words), len(set(words)))]


def test_defined_results(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (None, "a b " * 10, "x"), (4, "a b " * 10, "x"), (4, "a b " * 10, "x"),
            (5, "a b " * 12, "x"), (6, "ab\x0bab\x0c" * 6, "x"), (1 << 60 | 1, "x", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs string").coalesce(1)
    got = [tuple(r) for r in word_runs(docs, listed=True, kept_text=True).collect()]
    assert len(got) == 9 and (1 << 60 | 1) in [r[0] for r in got]
    by = {r[0]: r for r in got}
    for k in (1, 2, 3):
        assert by[k][1:6] == (0, None, None, None, None) and by[k][8] == [] and by[k][9] == ""
    assert by[4][1:6] == (1, 0, 20, 2, 10000) and by[4][9] == "a b" and by[None][1:] == by[4][1:]
    assert by[5][1:5] == (1, 0, 12, 1)  # only ASCII white space separates words
    assert by[6][1:5] == (1, 0, 12, 1)
    assert word_runs(docs.where(F.lit(False))).count() == 0


def test_null_key_text_stays_as_it_is(spark):
    docs = spark.createDataFrame([(None, "a b c d e f g h i j k l m n o p")], "doc_id long, text string")
    assert word_runs(docs, periodic_ends=True).first().n_runs == 0
