"""Vector codes against a plain Lloyd on Python integers."""

from __future__ import annotations

import hashlib
import math
import random

from pyspark.sql import functions as F

from zoneflow.llm import catalog
from zoneflow.llm.vector_codes import compress, learnt, nearest_entries, smallest_rows

SF = "/root/testdata/sf0.01"


def plain(rows, parts=16, entries=64, rounds=2):
    """rows: (key, vector, label); one result row each, in order of the given rows."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = parts * max(-(-max((len(r[1]) for r in kept), default=0) // parts), 1)
    ints = [[math.floor(256 * x) for x in v] + [0] * (width - len(v)) for _, v, _ in kept]
    size = width // parts
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for v in ints]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, ints[i]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        found = [[near(c[p], books[p])[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for e in range(len(first)):
                mine = [c[p] for c, f in zip(cut, found) if f[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    out = []
    for (key, _, label), c in zip(kept, cut):
        best = [near(c[p], books[p]) for p in range(parts)]
        out.append([key, "".join("%02x" % k for _, k in best), sum(d for d, _ in best), label])
    shown = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(k, c, e, sum(r[2] for r in out if r[3] == lab), shown) for k, c, e, lab in out]


def order(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_query_equals_plain_lloyd(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert order(catalog.QUERIES["op11_vector_codes"](spark, SF).collect()) == order(plain(rows))


def test_odd_rows_and_settings(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.uniform(-3, 3) for _ in range(10)], i % 3 or None) for i in range(60)]
    rows += [(i, list(rows[5][1]), 7) for i in range(60, 100)]  # a hot vector
    rows += [(1, list(rows[1][1]), 1), (1, list(rows[2][1]), 1), (None, list(rows[3][1]), 1), (200, [], 1), (201, [1.0] * 13, 2),
             (202, None, 2), (203, [1.0, None], 2), (204, [float("nan")], 2), (205, [float("-inf")], 2), (206, [1e12, -1e12], None), (1 << 60 | 1, [0.5], 3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("code", F.lit(1)).repartition(4)
    got = compress(frame, parts=4, entries=9, rounds=3, owner_rows=5)
    assert order(got.collect()) == order(plain(rows, 4, 9, 3))
    assert compress(frame.where(F.lit(False))).collect() == []
    few = spark.createDataFrame(rows[:5], "vec_id long, embedding array<double>, label int")
    assert order(compress(few).collect()) == order(plain(rows[:5]))


def test_ties_go_to_the_lower_entry_and_large_numbers_stay_exact():
    import numpy as np

    book = [[4, 0], [0, 4], [4, 0]]
    assert nearest_entries(np.array([[0, 0], [4, 0], [1, 3]]), book)[0].tolist() == [0, 0, 1]
    far = 1 << 61
    entry, distance = nearest_entries(np.array([[far, 1], [far, -1]]), [[-far, 0], [far, 0]])
    assert entry.tolist() == [1, 1] and distance.tolist() == [1, 1]
    assert nearest_entries(np.array([[far, 1]]), [[-far, 0]])[1].tolist() == [(2 * far) ** 2 + 1]


def test_smallest_rows_without_ordering_all(spark):
    frame = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("key"), F.array("id").alias("ints"))
    want = sorted(i * 7919 % 20_011 for i in range(20_000))[:64]
    assert [k for k, _ in smallest_rows(frame, 64)] == want


def test_only_changed_members_migrate(spark):
    """Between the rounds the one exchange of members is of rows whose entry changes."""
    rnd = random.Random(8)
    frame = spark.createDataFrame([(i, [rnd.randint(-200, 200) for _ in range(8)]) for i in range(300)], "key long, ints array<bigint>")
    one, two = learnt(frame, 4, 8, 1, 20), learnt(frame, 4, 8, 2, 20)
    rows = [(r.key, [x / 256 for x in r.ints], 0) for r in frame.collect()]
    shown = lambda b: hashlib.sha256(",".join(str(x) for p in b for e in p for x in e).encode()).hexdigest()
    assert shown(one) == plain(rows, 4, 8, 1)[0][4] and shown(two) == plain(rows, 4, 8, 2)[0][4]
