"""The pipeline: every stage's decisions take effect, and run() equals the stages one by one."""

import corpus_pipeline
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zoneflow.llm import catalog, jaccard, mixing, secrets

SF = "/root/testdata/sf0.01"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        seen[name] = (before, docs)
        if name != "bpe":
            assert docs.columns == columns and docs.schema["n_chars"].dataType == before.schema["n_chars"].dataType
    before, after = seen["toxicity"]
    assert 0.8 * before.count() < after.count() < before.count()
    before, after = seen["near_duplicates"]
    assert after.count() == jaccard.near_duplicates(before).select("class_id").distinct().count()
    assert jaccard.near_duplicates(after).where("n_links > 0").count() == 0
    before, after = seen["secrets"]
    assert after.count() == before.count()
    assert secrets.secret_report(after).agg(F.sum(F.col("n_access") + F.col("n_hex"))).first()[0] == 0
    assert after.where("text LIKE '%[SECRET]%' AND n_chars <> length(text)").count() == 0
    before, after = seen["mixing"]
    times = after.groupBy("doc_id").count()
    report = mixing.mix_report(before).where("taken > 0").select("doc_id", (F.col("taken") / F.col("size")).cast("long").alias("count"))
    assert sorted(map(tuple, times.collect())) == sorted(map(tuple, report.collect()))
    before, after = seen["bpe"]
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    texts = {r.doc_id: r.text for r in before.collect()}
    rows = after.collect()
    assert len(rows) == before.count()
    assert all(list(r.ids) == library.encode(texts[r.doc_id], add_special_tokens=False).ids for r in rows[::10])
    got = catalog.QUERIES["pipeline"](spark, SF)
    assert got.columns == after.columns
    assert sorted((r.doc_id, r.ids_sha256) for r in got.collect()) == sorted((r.doc_id, r.ids_sha256) for r in rows)


def test_stages_on_nulls_repeats_and_empty_tables(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "five words are in here", "en", None, 22),
            (None, "five words are in here", "en", None, 22), (3, "token=abcdefgh " * 50, None, "a", 750),
            (3, "token=abcdefgh " * 50, None, "a", 750), (4, "w " * 40_000, "en", "a", 80_000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            if name == "near_duplicates":
                assert docs.count() == (5 if data else 0)
        assert docs.count() >= (2 if data else 0)


def test_stages_keep_columns_of_any_name(spark):
    """Extra columns with the names of helper columns stay as they are, and n_chars may be missing."""
    names = ["_own", "_key", "_digest", "_spans", "_times", "_below", "_again", "digest", "key", "doc", "spans"]
    texts = ["alpha beta gamma delta epsilon zeta token=abcdefgh1234 eta theta", "some other words that stand here for a text of its own"]
    docs = spark.createDataFrame([(i, texts[i % 2], "en", "s", *[f"{n}{i}" for n in names]) for i in range(4)],
                                 ["doc_id", "text", "lang", "source", *names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", *names], name
        assert all(tuple(r)[4:] == tuple(f"{n}{r.doc_id}" for n in names) for r in docs.collect()), name
