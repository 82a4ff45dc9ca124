"""Per-user recency / activity / value features and min-max scaling.

Plan shape: one scan of the log into a partial+final hash aggregate per
user, written once to the shared checkpoint folder.  The cut-off and the
six scaling bounds come from one aggregate over that (much smaller) table
as a single driver row; the final projection uses them as literals, so
there is no cross join, no single-partition window and no second scan of
the log.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartograph.functions.columns import behavior_weight, day_difference, min_max_scale
from cartograph.schema import FEATURE_DECIMALS
from cartograph.session import materialize


def global_cutoff(log: DataFrame) -> DataFrame:
    """Latest timestamp over the whole log, one row ``max_ts``."""
    return log.agg(F.max("ts").alias("max_ts"))


def user_aggregate(log: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """``(user_id, max_ts, activity_count, value_score)`` per user.

    Map-side partial aggregation keeps a hot user's rows from reaching one
    task; every row counts (duplicates included).
    """
    return log.groupBy("user_id").agg(
        F.max("ts").alias("max_ts"),
        F.count(F.lit(1)).alias("activity_count"),
        F.sum(behavior_weight("behavior_type", weights)).cast("double").alias("value_score"),
    )


def merge_user_aggregates(*aggs: DataFrame) -> DataFrame:
    """Merge partial per-user aggregates (e.g. per split or per day)."""
    u = reduce(lambda a, b: a.unionByName(b), aggs)
    return u.groupBy("user_id").agg(
        F.max("max_ts").alias("max_ts"),
        F.sum("activity_count").alias("activity_count"),
        F.sum("value_score").alias("value_score"),
    )


def aggregate_bounds(agg: DataFrame) -> dict:
    """Cut-off and the bounds of the three features, as driver scalars.

    One aggregate over the per-user table returns a single row.  Recency is
    a decreasing function of ``max_ts``, so its bounds follow from the min and
    max of ``max_ts``.
    """
    row = agg.agg(
        F.max("max_ts").alias("max_ts_max"),
        F.min("max_ts").alias("max_ts_min"),
        F.min("activity_count").cast("double").alias("activity_min"),
        F.max("activity_count").cast("double").alias("activity_max"),
        F.min("value_score").cast("double").alias("value_min"),
        F.max("value_score").cast("double").alias("value_max"),
    ).first()
    return row.asDict()


def features_from_aggregate(agg: DataFrame) -> DataFrame:
    """``(user_id, recency_days, activity_count, value_score)``.

    Recency is days before the latest timestamp of all users (larger is
    staler); the cut-off is the max of the per-user maxima.
    """
    cutoff = F.lit(agg.agg(F.max("max_ts")).first()[0])
    return agg.select(
        "user_id",
        day_difference(cutoff, F.col("max_ts")).alias("recency_days"),
        "activity_count",
        "value_score",
    )


def user_features(log: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    return features_from_aggregate(materialize(user_aggregate(log, weights), "user-aggregate"))


def feature_bounds(features: DataFrame, cols: Sequence[str] = ("recency_days", "activity_count", "value_score")) -> DataFrame:
    """One row with ``<col>_min`` / ``<col>_max`` for each column."""
    return features.agg(*[c.alias(k) for k, c in bound_columns(cols).items()])


def bound_columns(cols: Sequence[str] = ("recency_days", "activity_count", "value_score")) -> dict[str, Column]:
    """The aggregates of :func:`feature_bounds`."""
    return {f"{c}_{k}": f(F.col(c).cast("double")) for c in cols for k, f in (("min", F.min), ("max", F.max))}


def min_max_normalize(features: DataFrame,
                      cols: Sequence[str] = ("recency_days", "activity_count", "value_score"),
                      names: Sequence[str] = ("f1", "f2", "f3"),
                      keep: Sequence[str] = ("user_id",),
                      decimals: int | None = FEATURE_DECIMALS, bounds: Mapping[str, float] | None = None) -> DataFrame:
    """Scale each column to [0, 1]; a constant column becomes 0.5.

    All bounds come from one aggregate returning a single row (pass a
    materialised ``features`` frame, it is read twice) unless ``bounds`` has them.  ``decimals`` rounds HALF_UP like the fixed-point text output (``None``
    keeps full precision).
    """
    bounds = bounds or feature_bounds(features, cols).first().asDict()
    out = [F.col(k) for k in keep]
    for c, n in zip(cols, names, strict=True):
        scaled = min_max_scale(c, F.lit(bounds[f"{c}_min"]), F.lit(bounds[f"{c}_max"]))
        if decimals is not None:
            scaled = F.round(scaled, decimals)
        out.append(scaled.alias(n))
    return features.select(*out)


def normalized_features_from_aggregate(agg: DataFrame,
                                       decimals: int | None = FEATURE_DECIMALS) -> DataFrame:
    """Per-user aggregate -> ``(user_id, f1, f2, f3)``.

    ``agg`` should be materialised (it is read twice: once for the bounds,
    once for the projection).  An empty aggregate gives an empty result.
    """
    b = aggregate_bounds(agg)
    if b["max_ts_max"] is None:
        return agg.select("user_id", *[F.lit(None).cast("double").alias(f"f{i}") for i in (1, 2, 3)])
    cutoff = F.lit(b["max_ts_max"])
    recency = day_difference(cutoff, F.col("max_ts"))
    cols = [
        (recency, day_difference(cutoff, F.lit(b["max_ts_max"])), day_difference(cutoff, F.lit(b["max_ts_min"]))),
        (F.col("activity_count"), F.lit(b["activity_min"]), F.lit(b["activity_max"])),
        (F.col("value_score"), F.lit(b["value_min"]), F.lit(b["value_max"])),
    ]
    out = [F.col("user_id")]
    for i, (v, lo, hi) in enumerate(cols, 1):
        scaled = min_max_scale(v, lo, hi)
        if decimals is not None:
            scaled = F.round(scaled, decimals)
        out.append(scaled.alias(f"f{i}"))
    return agg.select(*out)


def normalized_user_features(log: DataFrame, weights: Mapping[str, float] | None = None,
                             decimals: int | None = FEATURE_DECIMALS) -> DataFrame:
    """Clean log -> ``(user_id, f1, f2, f3)`` scaled features."""
    agg = materialize(user_aggregate(log, weights), "user-aggregate")
    return normalized_features_from_aggregate(agg, decimals=decimals)
