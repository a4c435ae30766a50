"""Queries of the text operators, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from zoneflow.llm import (bpe, html_text, jaccard, language, mixing, neighbours, quality_net, quality_rules, runs, secrets, suffix_dedup,
                          toxicity, vector_codes)
from zoneflow.llm.common import table


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every whole page."""
    return html_text.page_texts(table(spark, sf_dir, "pages"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text."""
    return language.identify(table(spark, sf_dir, "documents"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest others of every hundredth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of good quality for every whole text."""
    return quality_net.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of being toxic for every whole text."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate class (5-word sets, similarity 0.8 or more) and its number of links."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text: the three base kinds, and tokens that pass the randomness battery."""
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every whole text, and whether the cascade of rules keeps it."""
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all documents to target weights takes of each."""
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact ids of every whole text, and the digest of the text decoded from them."""
    import public_tokenizers

    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                with_ids=False)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as sixteen codebook entries, with its error and its label's."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every whole text without the 100-byte strings that start earlier."""
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every whole text, some of whose ends are made periodic."""
    return runs.word_runs(table(spark, sf_dir, "documents"), periodic_ends=True)


QUERIES = {
    "op1_html": op1_html,
    "op2_language": op2_language,
    "op3_nearest": op3_nearest,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_secrets": op7_secrets,
    "op8_quality_rules": op8_quality_rules,
    "op9_mixing": op9_mixing,
    "op10_bpe": op10_bpe,
    "op11_vector_codes": op11_vector_codes,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_runs": op13_runs,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op6_jaccard_join": jaccard.SQL,
    "op8_quality_rules": quality_rules.SQL,
    "op9_mixing": mixing.SQL,
    "op11_vector_codes": vector_codes.SQL,
    "op12_suffix_dedup": suffix_dedup.SQL,
}
