"""Mixing: the plan against a plain water-filling and running totals, the query against DuckDB, edge cases."""

import random

import duckdb

from zoneflow.llm import catalog, mixing


def brute(rows):
    """taken by row of (key, text, source)."""
    size = [len((t or "").encode().split()) for _, t, _ in rows]
    names = sorted({s for *_, s in rows if s is not None}) + [None] * any(s is None for *_, s in rows)
    total = {n: sum(z for z, (*_, s) in zip(size, rows) if s == n) for n in names}
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, open_ = {}, set(names)
    left = 1.5 * sum(total.values())
    while open_:
        level = left / sum(weight[n] for n in open_)
        over = {n for n in open_ if weight[n] * level > 2 * total[n]}
        if not over:
            target |= {n: weight[n] * level for n in open_}
            break
        target |= {n: 2.0 * total[n] for n in over}
        left -= sum(2 * total[n] for n in over)
        open_ -= over
    return size, total, target


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")


def test_targets_sizes_and_budgets(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(60), rng.choice(["a", "a", "a", "b", "é", "Z", None, "one"])) for i in range(800)]
    size, total, target = brute(rows)
    got = {r.doc_id: r for r in mixing.mix_report(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    taken = dict.fromkeys(total, 0)
    for z, (k, _, s) in zip(size, rows):
        r = got[k]
        assert (r.size, r.source_size) == (z, total[s]) and abs(r.target - target[s]) < 1e-6
        assert r.taken <= 2 * r.size
        taken[s] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= 30  # half of the largest document
    again = {r.doc_id: r.taken for r in mixing.mix_report(frame(spark, rows[::-1]).repartition(3)).collect()}
    assert again == {k: r.taken for k, r in got.items()}
    mix = mixing.mixed_documents(frame(spark, rows))
    assert mix.columns == ["doc_id", "text", "source", "size"]
    assert sum(len(r.text.split()) for r in mix.collect()) == sum(taken.values())


def test_nulls_ties_and_empty_tables(spark):
    rows = [(None, None, None), (None, "a b c", None), (1, "", "s"), (2, "x y", "s"), (2, "x y", "s"), (3, None, "t")]
    got = mixing.mix_report(frame(spark, rows)).collect()
    assert len(got) == 6 and sum(r.size for r in got) == 7
    assert len({r.taken for r in got if r.doc_id == 2}) == 1
    assert {r.target for r in got if r.source_size == 0} == {0.0}
    assert mixing.mix_report(frame(spark, rows).limit(0)).count() == 0


def test_query_equals_duckdb(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(catalog.SQL["op9_mixing"]).fetchall())
    got = sorted(tuple(r) for r in catalog.QUERIES["op9_mixing"](spark, sf).select("doc_id", "size", "source_size", "target", "taken").collect())
    assert got == want


def test_twin_splits_words_at_the_same_six_characters(spark, tmp_path):
    text = "a b\tc\nd\x0be\x0cf\rg\xa0h\x85i\x1cj"
    docs = spark.createDataFrame([(1, text, "s"), (2, "x y", "t")], "doc_id long, text string, source string")
    docs.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = {r[0]: r[1] for r in con.execute(catalog.SQL["op9_mixing"]).fetchall()}
    assert want == {1: 7, 2: 2} == {r.doc_id: r.size for r in mixing.mix_report(docs).collect()}


def test_columns_of_documents_may_have_any_name(spark):
    names = ["_times", "_below", "_again", "_s", "times", "below", "s", "h", "own", "doc", "a.b"]
    docs = spark.createDataFrame([(i, "one two three", "s", *["x"] * len(names)) for i in range(4)], ["doc_id", "text", "source", *names])
    mix = mixing.mixed_documents(docs)
    assert mix.columns == docs.columns and all(tuple(r)[3:] == ("x",) * len(names) for r in mix.collect())
