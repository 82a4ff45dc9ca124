"""Registered queries of the text-corpus operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartograph.llm import (bpechunks, embedjoin, mixing, ngramjoin, quality, secrets, sharding, sql, tokenfile,
                            toxicity, urlfilter, variants, whitening, wrappers)
from cartograph.llm.common import read_table

QUERIES = {}
ORACLE = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


@register("op8_secret_blob_ledger", sql.SECRETS)
def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secrets.scan(read_table(spark, sf_dir, "documents", "doc_id", "text"), path="doc_id")
    return found.select(
        F.col("path").alias("doc_id"), *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.digest(secrets.BASE), 256).alias("base_sha256"), secrets.digest(secrets.RULES).alias("spans"))


@register("op9_minimax_shards", sql.SHARDS)
def q_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op10_raked_mixture", sql.MIXTURE)
def q_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    return mixing.mix(docs).select("doc_id", F.col("__topic").alias("topic"), F.col("__tokens").alias("tokens"),
                                   F.round("__prob", 6).alias("prob"), F.col("__sampled").alias("sampled"))


@register("op1_toxicity_automaton")
def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    rated = toxicity.rate(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return rated.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
                        (F.col("__score") >= 0.5).cast("int").alias("predicted"))


@register("op4_token_blocks")
def q_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return tokenfile.read_tokens(tokenfile.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json")))


@register("op5_risk_controlled_rules")
def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang"),
                         read_table(spark, sf_dir, "labels", "doc_id", "quality"))


@register("op6_bpe_chunk_reuse")
def q_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpechunks.encode(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                            public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])


@register("op2_embedding_pigeonhole", sql.EMBEDDINGS)
def q_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedjoin.near_duplicates(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@register("op3_chosen_path_join", sql.JACCARD)
def q_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.classify(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op7_html_wrappers")
def q_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


@register("op12_url_automaton", sql.URLS)
def q_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(read_table(spark, sf_dir, "pages", "page_id", "url"))


@register("op13_gram_variants", sql.VARIANTS)
def q_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op11_feast_whitening")
def q_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
