"""Corpus pipeline: toxicity, near-duplicates, secrets, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next stage's docs.  All but the last keep the columns of ``documents``, extra ones
and such with names that operators use included.

Defined results: null and empty texts are clean and equal to each other, so one of them stays; equal
rows (and equal texts under different ids) leave one; null ids, languages and sources are values of
their own; a very long text goes through every stage whole; an empty table gives no rows; without labels
no document is toxic.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartograph.llm import bpechunks, mixing, ngramjoin, secrets, toxicity
from cartograph.llm.common import keeps_columns
from cartograph.session import materialize

# toxicity scores are not SQL: run() is tested against a brute-force version
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below one half stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return keeps_columns(lambda d: toxicity.rate(d, labels).where("__score < 0.5"))(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts stays: the smallest doc_id."""
    return ngramjoin.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; found secrets are masked in their texts."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by calibrated probabilities, raked to smoothed source, language and topic shares."""
    return mixing.sample(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens and digests of its ids and of the decoded text."""
    return bpechunks.encode(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixture", mix_sources),
    ("tokens", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return docs
