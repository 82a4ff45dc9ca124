"""K-means over the scaled user features.

Plan shape per turn: the K centres are literals in one projection (no join,
no broadcast of data that grows), nearest-centre assignment is an
``array_min`` over ``struct(distance, cluster_id)`` (ties go to the lower
id), and the per-cluster sums are a partial+final aggregate whose result has
at most K rows -- the only data that reaches the driver.  The points are
written once to the shared checkpoint folder, so every turn re-reads a
columnar table with no lineage behind it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartograph.functions.columns import euclidean_distance, exact_sum
from cartograph.schema import FEATURE_COLUMNS, KMEANS_K, KMEANS_MAX_ITER, KMEANS_TOL
from cartograph.session import loop_session, observed, scratch_path

Centres = list[tuple[float, ...]]


def restrict_to_users(features: DataFrame, users: DataFrame) -> DataFrame:
    """Keep feature rows of users present in ``users`` (left semi join)."""
    return features.join(users.select("user_id"), "user_id", "left_semi")


def init_centres(points: DataFrame, k: int = KMEANS_K, method: str = "smallest_ids",
                 seed: int = 42, cols: Sequence[str] = FEATURE_COLUMNS) -> Centres:
    """K initial centres (driver list; K rows at most are taken).

    ``smallest_ids``: rows of the k smallest user ids, in id order.
    ``seeded``: rows of the k smallest ``md5(user_id ':' seed)`` -- a
    repeatable stand-in for a random sample.  Fewer rows than k are
    padded by repeating the last one.
    """
    if method == "smallest_ids":
        order = [F.col("user_id")]
    elif method == "seeded":
        order = [F.md5(F.concat_ws(":", F.col("user_id").cast("string"), F.lit(str(seed)))), F.col("user_id")]
    else:
        raise ValueError(f"unknown init method {method!r}")
    rows = points.orderBy(*order).select(*cols).limit(k).collect()
    centres = [tuple(float(v) for v in r) for r in rows]
    while centres and len(centres) < k:
        centres.append(centres[-1])
    return centres


def centres_frame(spark: SparkSession, centres: Centres, cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """``(cluster_id, f1, f2, f3)`` from a driver list of K centres."""
    schema = "cluster_id int, " + ", ".join(f"{c} double" for c in cols)
    return spark.createDataFrame([(i, *c) for i, c in enumerate(centres)], schema)


def nearest_centre(centres: Centres, cols: Sequence[str] = FEATURE_COLUMNS) -> Column:
    """Index of the nearest centre; ties go to the lowest index."""
    xs = [F.col(c) for c in cols]
    cands = [F.struct(euclidean_distance(xs, [F.lit(float(v)) for v in centre]).alias("d"),
                      F.lit(i).alias("i"))
             for i, centre in enumerate(centres)]
    return F.array_min(F.array(*cands))["i"]


def assign_nearest(points: DataFrame, centres: Centres, cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """``points`` + ``cluster_id``."""
    return points.withColumn("cluster_id", nearest_centre(centres, cols))


def cluster_sums(points: DataFrame, centres: Centres, cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Per-cluster ``n`` and ``sum_<col>`` (at most K rows).

    The sums are exact, so centres are the same bit for bit however the points
    are split over tasks and in whatever order partial sums meet.
    """
    return (assign_nearest(points, centres, cols).groupBy("cluster_id")
            .agg(F.count(F.lit(1)).alias("n"), *[exact_sum(c).alias(f"sum_{c}") for c in cols]))


def _merge(old: Centres, sums: list, cols: Sequence[str]) -> Centres:
    new = list(old)
    for r in sums:
        new[r["cluster_id"]] = tuple(r[f"sum_{c}"] / r["n"] for c in cols)
    return new


def update_centres(points: DataFrame, centres: Centres, cols: Sequence[str] = FEATURE_COLUMNS) -> Centres:
    """Means of the points assigned to each centre; an empty cluster keeps its centre."""
    return _merge(centres, cluster_sums(points, centres, cols).collect(), cols)


def update_centres_frame(points: DataFrame, centres: Centres,
                         cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """DataFrame form of :func:`update_centres`: old centres left join the means."""
    spark = points.sparkSession
    old = centres_frame(spark, centres, cols)
    means = cluster_sums(points, centres, cols).select(
        "cluster_id", *[(F.col(f"sum_{c}") / F.col("n")).alias(f"m_{c}") for c in cols])
    return old.join(means, "cluster_id", "left").select(
        "cluster_id", *[F.coalesce(F.col(f"m_{c}"), F.col(c)).alias(c) for c in cols])


def centre_shift(old: Centres, new: Centres) -> float:
    """Largest Euclidean move of a centre."""
    return max(math.sqrt(sum((a - b) * (a - b) for a, b in zip(o, n, strict=True)))
               for o, n in zip(old, new, strict=True))


@dataclass
class KMeansResult:
    centres: Centres
    labels: DataFrame          # (user_id, cluster_id)
    iterations: int
    converged: bool
    shifts: list[float] = field(default_factory=list)
    n_points: int = 0

    def centres_frame(self, spark: SparkSession, cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
        return centres_frame(spark, self.centres, cols)


def kmeans(points: DataFrame, k: int = KMEANS_K, max_iter: int = KMEANS_MAX_ITER,
           tol: float = KMEANS_TOL, init: Centres | str = "smallest_ids", seed: int = 42,
           cols: Sequence[str] = FEATURE_COLUMNS) -> KMeansResult:
    """Lloyd's algorithm; stops after the first turn whose largest centre
    shift is below ``tol`` (centres are replaced before the test) or after
    ``max_iter`` turns.  Labels use the final centres.
    """
    spark = points.sparkSession
    path = scratch_path(spark, "kmeans-points")
    _, seen = observed(points.select("user_id", *cols), lambda df: df.write.parquet(path), n=F.count(F.lit(1)))
    pts = spark.read.parquet(path)
    n = seen["n"]
    if n < k:
        raise ValueError(f"{n} points is fewer than k={k} clusters")
    centres = init_centres(pts, k, init, seed, cols) if isinstance(init, str) else [tuple(c) for c in init]
    if len(centres) != k:
        raise ValueError(f"expected {k} initial centres, got {len(centres)}")
    shifts: list[float] = []
    converged = False
    it = 0
    # each turn's aggregate has at most k groups
    turns = loop_session(spark, k).read.schema(pts.schema).parquet(path)
    for it in range(1, max_iter + 1):
        new = update_centres(turns, centres, cols)
        shift = centre_shift(centres, new)
        shifts.append(shift)
        centres = new
        if shift < tol:
            converged = True
            break
    labels = assign_nearest(pts, centres, cols).select("user_id", "cluster_id")
    return KMeansResult(centres=centres, labels=labels, iterations=it, converged=converged, shifts=shifts, n_points=n)


def cluster_sizes(labels: DataFrame, k: int = KMEANS_K) -> DataFrame:
    """``(cluster_id, n_users)`` for every cluster id ``0..k-1`` (0 when empty)."""
    spark = labels.sparkSession
    ids = spark.range(k).select(F.col("id").cast("int").alias("cluster_id"))
    counts = labels.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_users"))
    return ids.join(counts, "cluster_id", "left").select(
        "cluster_id", F.coalesce("n_users", F.lit(0)).cast("bigint").alias("n_users"))
