"""Quality rules: base counts and verdicts against plain code, the cascade's order, edge cases."""

import random
import re

from pyspark.sql import functions as F

from zoneflow.llm import catalog
from zoneflow.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    out = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
    return (*out, out[0] < 20 or 100 * out[4] > 30 * out[0])


def rows_of(frame):
    return [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in frame.collect()]


def test_base_counts_equal_plain_code(spark):
    rng = random.Random(8)
    texts = [None, "", " \n\t\x0b", "é漢🙂 \x85 \xa0 b c", "a\nb\n a\na\r\na\n\n\n", "x y " * 30, "## <b> | a"]
    texts += [" ".join(rng.choice("ab") + rng.choice(["", "\n", "#"]) for _ in range(rng.randrange(80))) for _ in range(150)]
    texts += [" ".join(f"w{i % 13}" for i in range(40_000)), "one " * 7, "one " * 8, "one " * 9]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    assert sorted(rows_of(q.quality(docs))) == [(i, *plain(t)) for i, t in enumerate(texts)]
    assert q.quality(docs.limit(0)).count() == 0
    twice = docs.union(docs.withColumn("doc_id", F.lit(None).cast("long")))
    assert q.quality(twice).count() == 2 * len(texts)


def test_order_is_by_rejection_per_cost_and_does_not_change_verdicts():
    prose = ("the quick brown fox jumps over a lazy dog while many other animals look on and think about "
             "what they have seen there today ").encode()
    texts = [prose] * 5 + [prose.upper()] * 30 + [prose.replace(b" ", b"!! ")] * 3 + [prose.replace(b" ", b"### ")] * 2
    times = iter(range(10**6))
    order = q.ordered(texts, lambda: float(next(times)))  # all rules cost alike
    assert order[0] == "upper_case" and sorted(order) == sorted(q.RULES)
    one, two = q.judge(texts, order), q.judge(texts, order[::-1])
    assert (one["kept"].values == two["kept"].values).all() and one["kept"].tolist() == [True] * 5 + [False] * 35


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = catalog.QUERIES["op8_quality_rules"](spark, sf).cache()
    assert sorted(rows_of(got)) == sorted((d.doc_id, *plain(d.text)) for d in docs.collect())
    labels = got.where("NOT base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    assert labels.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double"))).first()[0] >= 0.98


def test_long_scripts_are_measured_in_code_points(spark):
    import duckdb
    clean = " ".join("\u0ba4\u0bae\u0bbf\u0bb4\u0bcd\u0b9a\u0bca\u0bb1\u0bcd\u0b95\u0bb3\u0bcd"[: 6 + i % 7] + chr(0x0b85 + i) for i in range(40))
    long = " ".join("a" * 17 + chr(97 + i % 26) + str(i) for i in range(40))
    docs = spark.createDataFrame([(1, clean), (2, long)], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in q.quality(docs).collect()}
    assert got == {1: True, 2: False}
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert {r[0]: r[-1] for r in con.execute(catalog.SQL["op8_quality_rules"]).fetchall()} == got
