"""Repeated byte strings against a plain pass over all windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow.llm import catalog
from zoneflow.llm.suffix_dedup import longest_previous, marks, repeated_spans, spot_parts

SF = "/root/testdata/sf0.01"


def plain(docs, length):
    """By key, a set of all windows seen so far."""
    seen, out = set(), {}
    for key, text in sorted(docs, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[key] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def made(n, length, seed):
    rnd = random.Random(seed)
    passages = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(length // 2, 3 * length))) for _ in range(6)]
    docs = []
    for i in range(n):
        kind, text = rnd.random(), ""
        if kind < 0.3 and docs:
            text = docs[rnd.randrange(min(len(docs), 3))][1]  # a hot group of copies
        elif kind < 0.35:
            text = None
        elif kind < 0.42:
            text = "a" * rnd.randint(0, 6 * length)
        elif kind < 0.5:
            text = f"xyz{rnd.randint(0, 3)} " * rnd.randint(1, 60)
        else:
            for _ in range(rnd.randint(0, 5)):
                text += rnd.choice(passages) if rnd.random() < 0.5 else "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 2 * length)))
        docs.append((i, text))
    rnd.shuffle(docs)
    return docs


def by_key(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


@pytest.mark.parametrize("length,most", [(8, 20_000), (30, 2), (100, 20_000)])
def test_equal_to_a_plain_pass(spark, length, most):
    """Small blocks; with ``most`` 2, marks with three contexts or more are cut into windows."""
    docs = made(250, length, length)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert by_key(repeated_spans(frame, length=length, most_contexts=most, block_bytes=4000)) == plain(docs, length)


def test_query_equals_a_plain_pass(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = by_key(catalog.QUERIES["op12_suffix_dedup"](spark, SF))
    assert got == plain(docs, 100)
    assert sum(r[1] for r in got.values()) > 100_000


def test_every_window_has_one_mark_and_equal_windows_equal_marks():
    rnd = random.Random(2)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 300))) for _ in range(40)] + [b"z" * 500]
    number, mark, spot = marks(texts, 20)
    begin, windows = spot_parts(spot)
    seen, count = {}, 0
    for t, m, s, b, n in zip(number, mark, spot >> 32, begin, windows):
        for start in range(b, b + n):
            count += 1
            assert seen.setdefault(texts[t][start : start + 20], (m, s - start)) == (m, s - start)
    assert count == sum(max(len(t) - 19, 0) for t in texts)


def test_longest_previous_factors_equal_all_pairs():
    rnd = np.random.default_rng(4)
    rows = rnd.integers(0, 2, (120, 9)).astype(np.uint8)
    pos = rnd.permutation(120)

    def common(a, b):
        differ = np.flatnonzero(a != b)
        return int(differ[0]) if len(differ) else len(a)

    want = [max((common(rows[i], rows[j]) for j in range(120) if pos[j] < pos[i]), default=0) for i in range(120)]
    assert longest_previous(rows, pos, 0).tolist() == want


def test_defined_results(spark):
    long = "".join(chr(97 + i * i % 23) + str(i) for i in range(200))
    rows = [(1, None, 1), (2, "", 1), (None, long, 1), (3, long, 1), (3, long, 1), (4, "é" * 60, 1), (5, "short", 1), (5, "short", 1), (1 << 60 | 1, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block long").withColumn("row", F.lit("x"))
    got = sorted((tuple(r) for r in repeated_spans(docs, listed=True).collect()), key=str)
    assert (1 << 60 | 1) in [r[0] for r in got]
    assert len(got) == 9 and len([r for r in got if r[0] == 3 and r[2] == 0]) == 1
    size = len(long.encode())
    assert [r[1:4] for r in got if r[0] is None] == [(size, size, 1)]  # null keys come last
    assert [r for r in got if r[0] == 3 and r[2] == size][0][5][0].asDict() == {"start": 0, "end": size}
    assert [r[2:4] for r in got if r[0] == 4] == [(118, 1)] and [r[6] for r in got if r[0] == 4] == [bytearray("é".encode())]
    assert all(r[2] == 0 for r in got if r[0] in (1, 2, 5))
    assert repeated_spans(docs.where(F.lit(False))).count() == 0
    with pytest.raises(ValueError):
        repeated_spans(docs, length=3)


def test_one_very_long_text(spark):
    rnd = random.Random(9)
    part = "".join(rnd.choice("abcdefgh ") for _ in range(1_300_000))
    docs = spark.createDataFrame([(1, part + "-" + part[200_000:]), (2, part[:500_000])], "doc_id long, text string")
    got = by_key(repeated_spans(docs))
    assert got[1][1:3] == (1_100_000, 1) and got[2][1:3] == (500_000, 1)
