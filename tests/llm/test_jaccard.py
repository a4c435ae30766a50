"""Near duplicates: links and classes against brute force; bands; edge cases."""

import random

from zoneflow.llm import catalog, jaccard


def grams(text, n=5):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def brute(rows, least=0.8):
    """links by row (documents, different texts) and the smallest key of each component."""
    sets = [(k, t, grams(t)) for k, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    docs, texts = [0] * len(rows), [set() for _ in rows]
    for i, (_, t, a) in enumerate(sets):
        for j in range(i):
            u, b = sets[j][1], sets[j][2]
            if a and b and (t == u or 5 * len(a & b) >= 4 * len(a | b)):
                docs[i] += 1
                docs[j] += 1
                if t != u:
                    texts[i].add(u)
                    texts[j].add(t)
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    least_key = {}
    for i, (k, _) in enumerate(rows):
        least_key[find(i)] = min(k, least_key.get(find(i), k))
    return {(k, least_key[find(i)], docs[i], len(texts[i])) for i, (k, _) in enumerate(rows)}


def near_copy(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"w{rng.random()}"
    return " ".join(out)


def test_bands_reach_the_recall():
    bands, rows = jaccard.choose_bands(0.8, 0.999)
    assert jaccard.recall_of(bands, rows, 0.8) >= 0.999 and bands * rows <= jaccard.MOST_HASHES


def test_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TEXTS", 16)  # so that groups are cut into blocks
    rng = random.Random(1)
    rows = []
    for size, edits in ((40, 2), (30, 4), (2, 1), (3, 3)):
        words = [f"x{rng.randrange(500)}" for _ in range(200)]
        rows += [near_copy(rng, words, rng.randrange(edits + 1)) for _ in range(size)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(100)) for _ in range(60)]
    rows += ["a b", "a b", "a b c", "", " \n", "same five words right here", "same  five words\nright here"]
    rows = [(1000 - i, t) for i, t in enumerate(rows)]
    docs = spark.createDataFrame([(k, t, k) for k, t in rows], "doc_id long, text string, class_id long")
    got = {(r.doc_id, r.class_id, r.n_links, r.n_text_links) for r in jaccard.near_duplicates(docs).collect()}
    assert got == brute(rows)


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, None), (2, None), (3, ""), (4, "one two three four five six"), (4, "one two three four five six"),
            (None, "one two three four five six"), (5, "x " * 20_000), (6, "x " * 20_001)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.class_id, r.n_links) for r in jaccard.near_duplicates(docs).collect())
    assert got == [("1", 1, 0), ("2", 2, 0), ("3", 3, 0), ("4", 4, 2), ("4", 4, 2), ("5", 5, 1), ("6", 5, 1), ("None", 4, 2)]
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = {(r.doc_id, r.class_id, r.n_links, r.n_text_links) for r in catalog.QUERIES["op6_jaccard_join"](spark, "/root/testdata/sf0.01").collect()}
    assert got == brute(rows)
