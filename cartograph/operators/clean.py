"""Cleaning, behaviour filters, split union and log statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.schema import DEEP_BEHAVIORS, VALID_BEHAVIORS

LOG_COLUMNS = ("user_id", "item_id", "category_id", "behavior_type", "ts")


def clean_behavior_log(log: DataFrame, valid: Sequence[str] = VALID_BEHAVIORS) -> DataFrame:
    """Keep records whose behaviour is one of ``valid`` (duplicates are kept)."""
    return log.where(F.col("behavior_type").isin(list(valid)))


def deep_interactions(log: DataFrame, deep: Sequence[str] = DEEP_BEHAVIORS) -> DataFrame:
    """Keep cart / fav / buy records."""
    return log.where(F.col("behavior_type").isin(list(deep)))


def union_splits(*splits: DataFrame) -> DataFrame:
    """Bag union of log splits (train then test); duplicates are kept."""
    return reduce(lambda a, b: a.unionByName(b), splits)


def log_stats(log: DataFrame, by: Sequence[str] = (), behaviors: Sequence[str] = VALID_BEHAVIORS) -> DataFrame:
    """Row, user and item counts plus one count per behaviour, optionally per group.

    One aggregation job; the distinct counts are exact.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("user_id").alias("n_users"),
            F.count_distinct("item_id").alias("n_items"),
            F.max("ts").alias("max_ts")]
    aggs += [F.count_if(F.col("behavior_type") == b).alias(f"n_{b}") for b in behaviors]
    return log.groupBy(*by).agg(*aggs) if by else log.agg(*aggs)
