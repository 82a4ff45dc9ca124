"""The four end-to-end jobs: text logs in, text results out.

Each takes paths like the original programs' positional arguments and
returns the main result as a DataFrame read back from what was written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartograph import sinks
from cartograph.operators import clean as C
from cartograph.operators import cluster as KM
from cartograph.operators import cooccur as CO
from cartograph.operators import features as FT
from cartograph.operators import rank as RK
from cartograph.schema import DEEP_BEHAVIORS, KMEANS_K, RANK_TOP_K, TOP_PAIRS, VALID_BEHAVIORS
from cartograph.session import materialize, observed
from cartograph.sources import text as TX


@dataclass
class JobOutput:
    result: DataFrame
    paths: dict
    stats: DataFrame           # (metric, value): the run's counts
    rejected: DataFrame | None = None    # (value, reason): lines that the parse refused


def _stats(spark: SparkSession, *parts, **scalars) -> DataFrame:
    """One ``(metric STRING, value DOUBLE)`` table from metric frames and scalars."""
    out = spark.createDataFrame([(k, float(v)) for k, v in scalars.items()], "metric string, value double")
    for p in parts:
        out = out.unionByName(p.select("metric", F.col("value").cast("double").alias("value")))
    return out


def _parsed(spark: SparkSession, train: str, test: str | None, **metrics) -> TX.Routes:
    """Both splits' lines, parsed in one scan each; a single path is read as both."""
    lines = [TX.read_lines(spark, p).withColumn("split", F.lit(n)) for n, p in (("train", train), ("test", test if test is not None else train))]
    return TX.write_routes(C.union_splits(*lines), keep=["split"], **metrics)


def run_features(spark: SparkSession, train: str, test: str, out: str) -> JobOutput:
    """Clean both splits, write the clean log and the scaled features.

    Statistics, all taken while the job writes: lines, rejected lines, records per split, clean
    records, latest time, users, bounds of the features.
    """
    in_log, valid = F.col("route") == TX.LOG, F.col("behavior_type").isin(*VALID_BEHAVIORS)
    routes = _parsed(spark, train, test, n_train_rows=F.count_if(in_log & (F.col("split") == "train")),
                     n_test_rows=F.count_if(in_log & (F.col("split") == "test")),
                     n_clean_rows=F.count_if(valid), max_ts=F.max(F.when(valid, F.col("ts"))))
    log_path, feat_path = f"{out}/clean_behavior_log.csv", f"{out}/user_features.csv"
    clean = C.clean_behavior_log(routes.log)
    sinks.write_clean_log(clean, log_path)
    raw, seen = observed(FT.user_features(clean), lambda df: materialize(df, "user-features"),
                         n_users=F.count(F.lit(1)), **FT.bound_columns())
    sinks.write_user_features(FT.min_max_normalize(raw, bounds=seen), feat_path)
    kept = ("n_lines", "n_train_rows", "n_test_rows", "n_clean_rows", "max_ts")
    notes = {k: routes.counts[k] for k in kept} | seen
    notes["n_rejected"] = routes.counts["n_rejected_arity"] + routes.counts["n_rejected_number"]
    return JobOutput(TX.read_user_features(spark, feat_path), {"clean_log": log_path, "features": feat_path},
                     _stats(spark, **{k: v for k, v in notes.items() if v is not None}), routes.rejected)


def run_cooccurrence(spark: SparkSession, train: str, test: str | None, out: str,
                     limit: int = TOP_PAIRS) -> JobOutput:
    """Inverted index and the top item pairs of the deep interactions.

    ``limit`` bounds the report: its rows end in one file.  Statistics: text
    lines, deep records, edges, indexed items, pairs (all taken while
    the job writes) and users.
    """
    routes = _parsed(spark, train, test, n_deep_rows=F.count_if(F.col("behavior_type").isin(*DEEP_BEHAVIORS)))
    one = F.count(F.lit(1))
    edges, n_edges = observed(CO.interaction_edges(routes.log), lambda df: materialize(df, "edges"), n_edges=one)
    idx_path, pair_path = f"{out}/item_user_inverted_index.txt", f"{out}/item_co_occurrence.txt"
    _, n_items = observed(CO.inverted_index(edges), lambda df: sinks.write_inverted_index(df, idx_path),
                          n_items=F.count_if(F.col("block") == 0))
    pairs, n_pairs = observed(CO.item_cooccurrence(edges), lambda df: materialize(df, "pairs"), n_pairs=one)
    sinks.write_cooccurrence(CO.top_item_pairs(pairs, limit), pair_path)
    notes = {k: routes.counts[k] for k in ("n_lines", "n_deep_rows")} | n_edges | n_items | n_pairs
    notes["n_users"] = edges.agg(F.count_distinct("user_id")).first()[0]
    return JobOutput(spark.read.text(pair_path), {"index": idx_path, "pairs": pair_path}, _stats(spark, **notes), routes.rejected)


def run_clustering(spark: SparkSession, features: str, out: str, train: str,
                   k: int = KMEANS_K, init="smallest_ids") -> JobOutput:
    """K-means over the written features of the training users.

    Statistics: distinct training users, users that enter clustering, turns,
    users per cluster.
    """
    users, n_users = observed(TX.read_user_ids(spark, train, strict=True), lambda df: materialize(df, "train-users"),
                              n_train_users=F.count(F.lit(1)))
    res = KM.kmeans(KM.restrict_to_users(TX.read_user_features(spark, features), users), k=k, init=init)
    c_path, l_path = f"{out}/cluster_centers.txt", f"{out}/user_cluster_labels.csv"
    sinks.write_centres(res.centres_frame(spark), c_path)
    _, sizes = observed(res.labels, lambda df: sinks.write_labels(df, l_path),
                        **{f"n_cluster_{i}": F.count_if(F.col("cluster_id") == i) for i in range(k)})
    stats = _stats(spark, n_clustered_users=res.n_points, iterations=res.iterations, **n_users, **sizes)
    return JobOutput(spark.read.text(l_path), {"centres": c_path, "labels": l_path, "iterations": res.iterations}, stats)


def run_rank(spark: SparkSession, train: str, test: str | None, out: str, target: int | Sequence[int],
             k: int = RANK_TOP_K) -> JobOutput:
    """Personal rank from ``target``; writes one recommendation line of ``k`` entries.

    With several targets all walk in one loop, and each has its line.  Statistics: nodes,
    users, items, edges; for a single target also its turns, whether it is in the graph, the
    top score and whether it prints as 0.000; for several the number in the graph and the most turns.
    """
    log = TX.read_behavior_log(spark, [train, test if test is not None else train],
                               require_category=False)
    edges = materialize(CO.interaction_edges(log), "edges")
    walks = RK.walks(RK.bipartite_edges(edges), [target] if isinstance(target, int) else target)
    path = f"{out}/personal_rank_recommendations.txt"
    if isinstance(target, int):
        res = walks.of(target)
        recs = materialize(RK.recommend_top_k(res, edges, target, k), "recommendations")
        top = RK.recommend_stats(recs).first()
        notes = {"iterations": res.iterations, "target_in_graph": res.target_in_graph}
        notes |= {"top_score": top["top_score"], "low_score": top["low_score"]} if top else {}
    else:
        recs = materialize(RK.recommend_many(walks, edges, k), "recommendations")
        notes = {"iterations": max(walks.iterations.values(), default=0), "targets_in_graph": sum(walks.in_graph.values())}
    sinks.write_recommendations(RK.recommendation_line(recs), path)
    stats = _stats(spark, RK.node_stats(walks.nodes), **notes)
    return JobOutput(spark.read.text(path), {"recommendations": path, "iterations": notes["iterations"]}, stats)
