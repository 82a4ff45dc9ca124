"""Helpers shared by the text-corpus operators."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartograph.session import materialize

WORD_RE = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Whole table ``name`` of ``sf_dir``, only ``columns``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def width(spark: SparkSession) -> int:
    """The session's shuffle width, for layouts that must name a partition count."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shape_of(docs: DataFrame, result: DataFrame) -> DataFrame:
    """``result`` with exactly the columns and order of ``docs``."""
    return result.select(*[F.col(f"`{c}`") for c in docs.columns])


def keeps_columns(operator):
    """For operators from documents to documents: ``docs`` may have columns under the names with ``__`` that
    operators add; they are set aside under free names and come back unchanged, in the same order."""

    @wraps(operator)
    def run(docs: DataFrame, *args, **kw) -> DataFrame:
        taken = set(docs.columns)
        aside = {c: next(n for n in (f"aside{i}_{k}" for k in range(len(taken) + 1)) if n not in taken)
                 for i, c in enumerate(docs.columns) if c.startswith("__")}
        inner = docs.withColumnsRenamed(aside)
        return shape_of(inner, operator(inner, *args, **kw)).withColumnsRenamed({v: k for k, v in aside.items()})

    return run


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Smallest reachable id of every endpoint of ``edges`` (u, v): columns node, component.

    Alternating large-star and small-star rounds: each round re-hangs every node on the smallest
    node it knows, so the edge table never grows and a hot node's neighbours are reduced by a
    partial ``min`` before they meet.  Every round is written to the shared folder (lineage cut);
    only its row count and checksums come back.  Null or equal endpoints carry no link.
    """
    e = (edges.select(F.col("u").cast("long"), F.col("v").cast("long"))
         .where("u is not null and v is not null and u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = materialize(e, "cc-edges")
    was = _mark(e)
    for _ in range(max_rounds):
        e = materialize(_star(_star(e, large=True), large=False), "cc-edges")
        was, before = _mark(e), was
        if was == before:
            break
    else:
        raise RuntimeError("components did not settle")
    root = e.selectExpr("u as node", "v as component")
    return root.unionByName(root.select(F.col("component").alias("node"), "component").distinct())


def _mark(e: DataFrame) -> tuple:
    """Row count and checksums of an edge table: equal for two rounds, nothing moved."""
    return tuple(e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.col("v").cast("decimal(38,0)"))).first())


def _star(e: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u > v)."""
    if large:
        both = e.union(e.selectExpr("v as u", "u as v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        hung = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.selectExpr("u", "m as v"))
    return (hung.where("u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
