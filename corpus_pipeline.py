"""A training corpus from ``documents``: toxic texts go, of near duplicates one stays, secrets are masked, sources are mixed
to their target weights, and the texts become token ids.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all rows of ``docs``; all but the last return the columns
of documents.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm import bpe, jaccard, mixing, secrets, toxicity
from zoneflow.llm.common import table, written

#: The vocabulary of the last stage: a path, never a copy.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a probability of 0.5 or more of being toxic go; the classifier learns from ``labels``."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of the smallest id stays."""
    return jaccard.without_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; no document goes. n_chars follows the text."""
    spans = "_spans"
    while spans in docs.columns:  # a name that documents don't have
        spans += "_"
    masked = secrets.redact(secrets.find_secrets(docs, out=spans), spans=spans)
    if "n_chars" in docs.columns:
        length = F.when(F.size(spans) > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        masked = masked.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (0, 1 or 2 times)."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the digests by which they can be checked against the decoded text."""
    return bpe.encode_documents(docs, VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: No SQL: the first two stages and the last are learnt, hashed and merged in ways that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written to the shared folder and read again by the next."""
    *stages, (_, last) = STAGES
    docs = reduce(lambda d, stage: written(stage[1](spark, d, sf_dir), stage[0]), stages, table(spark, sf_dir, "documents"))
    return last(spark, docs, sf_dir)
