"""Registered queries: one Spark builder and (where SQL can say it) one
DuckDB oracle per operator.  Every builder reads the driver tables under
``sf_dir`` (through the adapters) and runs over them whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartograph import sinks as SK
from cartograph import functions as FN
from cartograph.operators import clean as C
from cartograph.operators import cooccur as CO
from cartograph.operators import cluster as KM
from cartograph.operators import features as FT
from cartograph.operators import rank as RK
from cartograph.plans import jobs as J
from cartograph.plans import oracle as O
from cartograph.plans import state as ST
from cartograph.session import materialize, scratch_path, tidy_session
from cartograph.sources import adapters as A
from cartograph.sources import text as TX

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _log(spark, sf_dir):
    """Events adapter, typed, all behaviours (split kept)."""
    return A.events_behavior_log(spark, sf_dir)


def _clean(spark, sf_dir):
    return C.clean_behavior_log(_log(spark, sf_dir))


# ---------------------------------------------------------------- features (T1)

@register("clean_behavior_log", O.CLEAN + """
SELECT user_id, item_id, category_id, behavior_type, ts, split FROM clean""")
def q_clean_behavior_log(spark, sf_dir):
    return _clean(spark, sf_dir).drop("event_id")


@register("union_splits", O.EV + """
SELECT user_id, item_id, category_id, behavior_type, ts FROM ev WHERE split = 'train'
UNION ALL
SELECT user_id, item_id, category_id, behavior_type, ts FROM ev WHERE split = 'test'""")
def q_union_splits(spark, sf_dir):
    log = _log(spark, sf_dir)
    cols = list(C.LOG_COLUMNS)
    return C.union_splits(log.where("split = 'train'").select(*cols),
                          log.where("split = 'test'").select(*cols))


@register("log_stats", O.CLEAN + """
SELECT split, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
       count(DISTINCT item_id) AS n_items, max(ts) AS max_ts,
       count(*) FILTER (WHERE behavior_type = 'pv') AS n_pv,
       count(*) FILTER (WHERE behavior_type = 'cart') AS n_cart,
       count(*) FILTER (WHERE behavior_type = 'fav') AS n_fav,
       count(*) FILTER (WHERE behavior_type = 'buy') AS n_buy
FROM clean GROUP BY split""")
def q_log_stats(spark, sf_dir):
    return C.log_stats(_clean(spark, sf_dir), by=["split"])


@register("global_cutoff", O.CLEAN + """
SELECT max(ts) AS max_ts FROM clean""")
def q_global_cutoff(spark, sf_dir):
    return FT.global_cutoff(_clean(spark, sf_dir))


@register("user_aggregate", O.USER_AGG + """
SELECT user_id, max_ts, activity_count, value_score FROM agg""")
def q_user_aggregate(spark, sf_dir):
    return FT.user_aggregate(_clean(spark, sf_dir))


@register("merge_user_aggregates", O.USER_AGG + """
SELECT user_id, max_ts, activity_count, value_score FROM agg""")
def q_merge_user_aggregates(spark, sf_dir):
    log = _clean(spark, sf_dir)
    return FT.merge_user_aggregates(FT.user_aggregate(log.where("split = 'train'")),
                                    FT.user_aggregate(log.where("split = 'test'")))


@register("user_features", O.FEATURES + """
SELECT user_id, recency_days, activity_count, value_score FROM feat""")
def q_user_features(spark, sf_dir):
    return FT.user_features(_clean(spark, sf_dir))


@register("feature_bounds", O.FEATURES + """
SELECT min(recency_days) AS recency_days_min, max(recency_days) AS recency_days_max,
       CAST(min(activity_count) AS DOUBLE) AS activity_count_min,
       CAST(max(activity_count) AS DOUBLE) AS activity_count_max,
       min(value_score) AS value_score_min, max(value_score) AS value_score_max FROM feat""")
def q_feature_bounds(spark, sf_dir):
    return FT.feature_bounds(FT.user_features(_clean(spark, sf_dir)))


@register("min_max_normalize", O.NORM + """
SELECT user_id, f1, f2, f3 FROM norm""")
def q_min_max_normalize(spark, sf_dir):
    feats = materialize(FT.user_features(_clean(spark, sf_dir)), "user-features")
    return FT.min_max_normalize(feats)


@register("user_features_norm", O.NORM + """
SELECT user_id, f1, f2, f3 FROM norm""")
def q_user_features_norm(spark, sf_dir):
    return FT.normalized_user_features(_clean(spark, sf_dir))


# ------------------------------------------------------------- co-occurrence (T2)

def _edges(spark, sf_dir):
    return CO.interaction_edges(_log(spark, sf_dir))


def _written_edges(spark, sf_dir):
    return materialize(_edges(spark, sf_dir), "edges")


def _lineitem_edges(spark, sf_dir):
    return materialize(CO.interaction_edges(A.lineitem_behavior_log(spark, sf_dir)), "edges")


def _list_text(col):
    return F.array_join((F.col(col) if isinstance(col, str) else col).cast("array<string>"), ",")


def _index_rows(idx):
    return idx.select("item_id", F.size("user_ids").cast("bigint").alias("n_users"), _list_text("user_ids").alias("user_ids"))


def _basket_rows(b):
    return b.select("user_id", F.size("item_ids").cast("bigint").alias("n_items"), _list_text("item_ids").alias("item_ids"))


@register("deep_interactions", O.DEEP + """
SELECT user_id, item_id, category_id, behavior_type, ts, split FROM deep""")
def q_deep_interactions(spark, sf_dir):
    return C.deep_interactions(_log(spark, sf_dir)).drop("event_id")


@register("interaction_edges", O.DEEP + """
SELECT user_id, item_id FROM edges""")
def q_interaction_edges(spark, sf_dir):
    return _edges(spark, sf_dir)


@register("inverted_index", O.DEEP + """
SELECT item_id, count(*) AS n_users, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS user_ids
FROM edges GROUP BY item_id""")
def q_inverted_index(spark, sf_dir):
    return _index_rows(CO.inverted_index(_written_edges(spark, sf_dir)))


@register("user_baskets", O.DEEP + """
SELECT user_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS item_ids
FROM edges GROUP BY user_id""")
def q_user_baskets(spark, sf_dir):
    return _basket_rows(CO.user_baskets(_written_edges(spark, sf_dir)))


@register("item_pairs", O.PAIRS + """
SELECT user_id, item_a, item_b FROM pairs""")
def q_item_pairs(spark, sf_dir):
    return CO.item_pairs(_written_edges(spark, sf_dir))


@register("item_pairs_split_baskets", O.PAIRS + """
SELECT user_id, item_a, item_b FROM pairs""")
def q_item_pairs_split_baskets(spark, sf_dir):
    # Same pairs with every basket above 8 items split into hash blocks:
    # exercises the hot-user path on the whole table.
    return CO.item_pairs(_written_edges(spark, sf_dir), block_size=8)


@register("item_cooccurrence", O.PAIRS + """
SELECT item_a, item_b, n_users FROM cooc""")
def q_item_cooccurrence(spark, sf_dir):
    return CO.item_cooccurrence(_written_edges(spark, sf_dir))


@register("top_item_pairs", O.PAIRS + """
SELECT item_a, item_b, n_users FROM cooc ORDER BY n_users DESC, item_a, item_b LIMIT 1000""")
def q_top_item_pairs(spark, sf_dir):
    return CO.top_item_pairs(CO.item_cooccurrence(_written_edges(spark, sf_dir)))


@register("top_item_pairs_pruned", O.PAIRS + """
SELECT item_a, item_b, n_users FROM cooc ORDER BY n_users DESC, item_a, item_b LIMIT 1000""")
def q_top_item_pairs_pruned(spark, sf_dir):
    return CO.top_item_pairs_pruned(materialize(_edges(spark, sf_dir), "edges"))


@register("cooccurrence_stats", O.PAIRS + """
SELECT 'n_deep_rows' AS metric, count(*) AS value FROM deep
UNION ALL SELECT 'n_edges', count(*) FROM edges
UNION ALL SELECT 'n_items', count(DISTINCT item_id) FROM edges
UNION ALL SELECT 'n_users', count(DISTINCT user_id) FROM edges
UNION ALL SELECT 'n_pairs', count(*) FROM cooc""")
def q_cooccurrence_stats(spark, sf_dir):
    log, edges = _log(spark, sf_dir), _written_edges(spark, sf_dir)
    return CO.cooccurrence_stats(log, edges, CO.item_cooccurrence(edges))


# ------------------------------------------------------------ personal rank (T4)

RANK_TARGET = O.RANK_TARGET
UNKNOWN_TARGET = -1
_RANK_MEMO: dict = {}


def _graph(spark, sf_dir):
    return RK.bipartite_edges(_edges(spark, sf_dir))


def _listing(spark, sf_dir):
    """What a memo of results over ``sf_dir`` depends on: its files, sizes and times."""
    files = spark.read.format("binaryFile").load(f"{sf_dir}/events.parquet").select("path", "length", "modificationTime")
    return (spark.sparkContext.applicationId, *map(tuple, files.orderBy("path").collect()))


def _walk(spark, sf_dir, target=RANK_TARGET) -> RK.RankResult:
    key = (_listing(spark, sf_dir), target)
    if key not in _RANK_MEMO:
        _RANK_MEMO[key] = RK.personal_rank(_graph(spark, sf_dir), target)
    return _RANK_MEMO[key]


def _r9(c):
    return F.round(F.col(c), 9).alias(c)


@register("bipartite_edges", O.GRAPH + """
SELECT src_kind, src_id, dst_kind, dst_id FROM bi""")
def q_bipartite_edges(spark, sf_dir):
    return _graph(spark, sf_dir)


@register("graph_nodes", O.GRAPH + """
SELECT kind, id FROM nodes""")
def q_graph_nodes(spark, sf_dir):
    return RK.graph_nodes(_graph(spark, sf_dir))


@register("out_degree", O.GRAPH + """
SELECT kind, id, out_deg FROM deg""")
def q_out_degree(spark, sf_dir):
    return RK.out_degree(_graph(spark, sf_dir))


@register("graph_stats", O.GRAPH + """
SELECT 'n_nodes' AS metric, count(*) AS value FROM nodes
UNION ALL SELECT 'n_users', count(*) FILTER (WHERE kind = 0) FROM nodes
UNION ALL SELECT 'n_items', count(*) FILTER (WHERE kind = 1) FROM nodes
UNION ALL SELECT 'n_edges', count(*) FROM bi""")
def q_graph_stats(spark, sf_dir):
    return RK.graph_stats(_graph(spark, sf_dir))


@register("rank_init", O.GRAPH + f"""
SELECT kind, id, 1.0::DOUBLE AS score FROM nodes WHERE kind = 0 AND id = {RANK_TARGET}""")
def q_rank_init(spark, sf_dir):
    return RK.rank_init(_graph(spark, sf_dir), RANK_TARGET)


@register("rank_step", O.rank_walk(max_iter=1) + """
SELECT kind, id, round(score, 9) AS score FROM walk WHERE turn = 1 AND score <> 0""")
def q_rank_step(spark, sf_dir):
    g = _graph(spark, sf_dir)
    return RK.rank_step(g, RK.rank_init(g, RANK_TARGET), RANK_TARGET).select("kind", "id", _r9("score"))


@register("dangling_mass", O.DEEP + f""",
d AS (SELECT count(*) AS n FROM edges WHERE user_id = {RANK_TARGET})
SELECT round(coalesce(sum(0.85::DOUBLE * (1.0::DOUBLE / d.n)), 0.0), 9) AS dangling
FROM edges, d WHERE edges.user_id = {RANK_TARGET}""")
def q_dangling_mass(spark, sf_dir):
    # user -> item only: items have no out-edges, so one turn moves mass onto
    # dangling nodes
    g = RK.directed_edges(_edges(spark, sf_dir))
    step = RK.rank_step(g, RK.rank_init(g, RANK_TARGET), RANK_TARGET)
    return RK.dangling_mass(step, g).select(_r9("dangling"))


@register("rank_delta", O.rank_walk(max_iter=1) + """
SELECT round(change, 9) AS max_change FROM chg WHERE turn = 1""")
def q_rank_delta(spark, sf_dir):
    g = _graph(spark, sf_dir)
    init = RK.rank_init(g, RANK_TARGET)
    return RK.rank_delta(init, RK.rank_step(g, init, RANK_TARGET)).select(_r9("max_change"))


@register("personal_rank", O.rank_walk() + """
SELECT kind, id, round(score, 9) AS score FROM final WHERE score <> 0""")
def q_personal_rank(spark, sf_dir):
    return _walk(spark, sf_dir).scores.select("kind", "id", _r9("score"))


@register("personal_rank_stats", O.rank_walk() + """
SELECT CAST(stop.turn AS BIGINT) AS iterations,
       EXISTS (SELECT 1 FROM chg WHERE change < 1e-4) AS converged FROM stop""")
def q_personal_rank_stats(spark, sf_dir):
    res = _walk(spark, sf_dir)
    return spark.range(1).select(F.lit(res.iterations).cast("bigint").alias("iterations"),
                                 F.lit(res.converged).alias("converged"))


@register("seen_items", O.DEEP + f"""
SELECT DISTINCT item_id FROM edges WHERE user_id = {RANK_TARGET}""")
def q_seen_items(spark, sf_dir):
    return RK.seen_items(_edges(spark, sf_dir), RANK_TARGET)


_TOP = O.rank_walk() + f""",
cand AS (SELECT n.id AS item_id, coalesce(f.score, 0.0) AS score
         FROM nodes n LEFT JOIN final f ON f.kind = 1 AND f.id = n.id
         WHERE n.kind = 1 AND n.id NOT IN (SELECT item_id FROM edges WHERE user_id = {RANK_TARGET})),
top AS (SELECT CAST({RANK_TARGET} AS BIGINT) AS target_id,
               CAST(row_number() OVER (ORDER BY score DESC, CAST(item_id AS VARCHAR)) AS INTEGER) AS rank,
               item_id, score
        FROM cand ORDER BY rank LIMIT 10)"""


@register("recommend_top_k", _TOP + """
SELECT target_id, rank, item_id, round(score, 9) AS score FROM top""")
def q_recommend_top_k(spark, sf_dir):
    recs = RK.recommend_top_k(_walk(spark, sf_dir), _edges(spark, sf_dir), RANK_TARGET)
    return recs.select("target_id", "rank", "item_id", _r9("score"))


@register("recommendation_line", _TOP + f"""
SELECT CAST(min(target_id) AS VARCHAR) || chr(9) ||
       string_agg(CAST(item_id AS VARCHAR) || ':' || {O.fixed('score', 3)}, ',' ORDER BY rank) AS value
FROM top""")
def q_recommendation_line(spark, sf_dir):
    recs = RK.recommend_top_k(_walk(spark, sf_dir), _edges(spark, sf_dir), RANK_TARGET)
    return RK.recommendation_line(recs)


@register("recommend_unknown_target", O.GRAPH + f"""
SELECT CAST({UNKNOWN_TARGET} AS BIGINT) AS target_id,
       CAST(row_number() OVER (ORDER BY CAST(id AS VARCHAR)) AS INTEGER) AS rank,
       id AS item_id, 0.0::DOUBLE AS score
FROM nodes WHERE kind = 1 ORDER BY CAST(id AS VARCHAR) LIMIT 10""")
def q_recommend_unknown_target(spark, sf_dir):
    res = _walk(spark, sf_dir, UNKNOWN_TARGET)
    return RK.recommend_top_k(res, _edges(spark, sf_dir), UNKNOWN_TARGET)


# ------------------------------------------------------------------ k-means (T3)

_KM_MEMO: dict = {}


def _train_users(spark, sf_dir):
    # user ids of every train-split line, read through the strict text path
    lines = A.log_lines(_log(spark, sf_dir).where("split = 'train'"))
    return TX.parse_user_ids(lines, strict=True)


def _points(spark, sf_dir):
    feats = FT.normalized_user_features(_clean(spark, sf_dir))
    return KM.restrict_to_users(feats, _train_users(spark, sf_dir))


def _kmeans(spark, sf_dir) -> KM.KMeansResult:
    key = _listing(spark, sf_dir)
    if key not in _KM_MEMO:
        _KM_MEMO[key] = KM.kmeans(_points(spark, sf_dir))
    return _KM_MEMO[key]


def _step_centres(pts):
    return KM.init_centres(pts, 3)[:2] + [O.FAR_CENTRE]


@register("read_user_ids", O.EV + """
SELECT DISTINCT user_id FROM ev WHERE split = 'train'""")
def q_read_user_ids(spark, sf_dir):
    return _train_users(spark, sf_dir)


@register("restrict_to_users", O.POINTS + """
SELECT user_id, f1, f2, f3 FROM pts""")
def q_restrict_to_users(spark, sf_dir):
    return _points(spark, sf_dir)


@register("init_centres", O.POINTS + """
SELECT cluster_id, f1, f2, f3 FROM init""")
def q_init_centres(spark, sf_dir):
    return KM.centres_frame(spark, KM.init_centres(_points(spark, sf_dir), 3))


@register("assign_nearest", O.STEP_CENTRES + """
SELECT user_id, cluster_id FROM asg""")
def q_assign_nearest(spark, sf_dir):
    pts = materialize(_points(spark, sf_dir), "points")
    return KM.assign_nearest(pts, _step_centres(pts)).select("user_id", "cluster_id")


@register("update_centres", O.STEP_CENTRES + """
SELECT cluster_id, round(f1, 9) AS f1, round(f2, 9) AS f2, round(f3, 9) AS f3 FROM c1""")
def q_update_centres(spark, sf_dir):
    pts = materialize(_points(spark, sf_dir), "points")
    return KM.update_centres_frame(pts, _step_centres(pts)).select(
        "cluster_id", _r9("f1"), _r9("f2"), _r9("f3"))


@register("centre_shift", O.STEP_CENTRES + f""",
d AS (SELECT {O._dist('a', 'b')} AS dist FROM c0 a JOIN c1 b ON a.cluster_id = b.cluster_id)
SELECT round(max(dist), 9) AS shift FROM d""")
def q_centre_shift(spark, sf_dir):
    pts = materialize(_points(spark, sf_dir), "points")
    old = _step_centres(pts)
    shift = KM.centre_shift(old, KM.update_centres(pts, old))
    return spark.range(1).select(F.round(F.lit(shift), 9).alias("shift"))


@register("cluster_sizes", O.STEP_CENTRES + """
SELECT c0.cluster_id, count(a.user_id) AS n_users
FROM c0 LEFT JOIN asg a ON a.cluster_id = c0.cluster_id GROUP BY c0.cluster_id""")
def q_cluster_sizes(spark, sf_dir):
    pts = materialize(_points(spark, sf_dir), "points")
    return KM.cluster_sizes(KM.assign_nearest(pts, _step_centres(pts)))


@register("kmeans_centres", O.kmeans_loop() + """
SELECT cluster_id, round(f1, 9) AS f1, round(f2, 9) AS f2, round(f3, 9) AS f3 FROM centres""")
def q_kmeans_centres(spark, sf_dir):
    return _kmeans(spark, sf_dir).centres_frame(spark).select(
        "cluster_id", _r9("f1"), _r9("f2"), _r9("f3"))


@register("kmeans_labels", O.kmeans_loop() + """
SELECT user_id, cluster_id FROM labels""")
def q_kmeans_labels(spark, sf_dir):
    return _kmeans(spark, sf_dir).labels


@register("kmeans_cluster_sizes", O.kmeans_loop() + """
SELECT c.cluster_id, count(l.user_id) AS n_users
FROM centres c LEFT JOIN labels l ON l.cluster_id = c.cluster_id GROUP BY c.cluster_id""")
def q_kmeans_cluster_sizes(spark, sf_dir):
    return KM.cluster_sizes(_kmeans(spark, sf_dir).labels)


@register("kmeans_stats", O.kmeans_loop() + """
SELECT CAST(kstop.turn AS BIGINT) AS iterations,
       EXISTS (SELECT 1 FROM shift WHERE shift < 1e-4) AS converged FROM kstop""")
def q_kmeans_stats(spark, sf_dir):
    res = _kmeans(spark, sf_dir)
    return spark.range(1).select(F.lit(res.iterations).cast("bigint").alias("iterations"),
                                 F.lit(res.converged).alias("converged"))


# ------------------------------------------------------------ text sources (T1-T4)

def _lines(spark, sf_dir):
    # written once, so the parser reads a plain text column as it would from files
    return materialize(A.damaged_log_lines(spark, sf_dir), "log-lines")


def _text_files(spark, sf_dir) -> list[str]:
    """Damaged lines written as text, one directory per split (train, test)."""
    lines = A.damaged_log_lines(spark, sf_dir)
    base = scratch_path(spark, "log-text")
    paths = []
    for split in ("train", "test"):
        path = f"{base}/{split}"
        lines.where(F.col("split") == split).select("value").write.text(path)
        paths.append(path)
    return paths


@register("read_lines", O.LINES + """
SELECT value FROM lines""")
def q_read_lines(spark, sf_dir):
    return TX.read_lines(spark, _text_files(spark, sf_dir))


@register("parse_behavior_lines", O.parsed() + """
SELECT split, user_id, item_id, category_id, behavior_type, ts FROM parsed""")
def q_parse_behavior_lines(spark, sf_dir):
    return TX.parse_behavior_lines(_lines(spark, sf_dir), keep=["split"])


@register("parse_behavior_lines_lenient", O.parsed(False) + """
SELECT split, user_id, item_id, category_id, behavior_type, ts FROM parsed""")
def q_parse_behavior_lines_lenient(spark, sf_dir):
    return TX.parse_behavior_lines(_lines(spark, sf_dir), require_category=False, keep=["split"])


@register("rejected_lines", O.parsed() + """
SELECT value, reason FROM rejected""")
def q_rejected_lines(spark, sf_dir):
    return TX.rejected_lines(_lines(spark, sf_dir))


@register("rejected_lines_lenient", O.parsed(False) + """
SELECT value, reason FROM rejected""")
def q_rejected_lines_lenient(spark, sf_dir):
    return TX.rejected_lines(_lines(spark, sf_dir), require_category=False)


@register("read_behavior_log", O.parsed() + """
SELECT user_id, item_id, category_id, behavior_type, ts FROM parsed""")
def q_read_behavior_log(spark, sf_dir):
    return TX.read_behavior_log(spark, _text_files(spark, sf_dir))


@register("clean_log_from_text", O.parsed() + """
SELECT user_id, item_id, category_id, behavior_type, ts FROM parsed
WHERE behavior_type IN ('pv', 'cart', 'fav', 'buy')""")
def q_clean_log_from_text(spark, sf_dir):
    return C.clean_behavior_log(TX.read_behavior_log(spark, _text_files(spark, sf_dir)))


# ------------------------------------------------------------ end-to-end jobs

def _clean_text_files(spark, sf_dir) -> list[str]:
    """Undamaged log lines per split (the training-user file of the clustering job)."""
    lines = A.log_lines(_log(spark, sf_dir))
    base = scratch_path(spark, "log-clean-text")
    paths = []
    for split in ("train", "test"):
        path = f"{base}/{split}"
        lines.where(F.col("split") == split).select("value").write.text(path)
        paths.append(path)
    return paths


@register("run_features", O.NORM_TEXT + """
SELECT user_id, f1, f2, f3 FROM norm""")
def q_run_features(spark, sf_dir):
    train, test = _text_files(spark, sf_dir)
    return J.run_features(spark, train, test, scratch_path(spark, "job-features")).result


@register("run_cooccurrence", O.PAIRS_TEXT + """
SELECT printf('%d,%d', item_a, item_b) || chr(9) || CAST(n_users AS VARCHAR) AS value
FROM (SELECT * FROM cooc ORDER BY n_users DESC, item_a, item_b LIMIT 1000)""")
def q_run_cooccurrence(spark, sf_dir):
    train, test = _text_files(spark, sf_dir)
    return J.run_cooccurrence(spark, train, test, scratch_path(spark, "job-cooccurrence")).result


@register("run_clustering", O.kmeans_loop_text() + """
SELECT CAST(user_id AS VARCHAR) || ',' || CAST(cluster_id AS VARCHAR) AS value FROM labels""")
def q_run_clustering(spark, sf_dir):
    train, test = _text_files(spark, sf_dir)
    feats = J.run_features(spark, train, test, scratch_path(spark, "job-features")).paths["features"]
    clean_train, _ = _clean_text_files(spark, sf_dir)
    return J.run_clustering(spark, feats, scratch_path(spark, "job-clustering"), clean_train).result


@register("run_rank", O.rank_walk_text() + f""",
cand AS (SELECT n.id AS item_id, coalesce(f.score, 0.0) AS score
         FROM nodes n LEFT JOIN final f ON f.kind = 1 AND f.id = n.id
         WHERE n.kind = 1 AND n.id NOT IN (SELECT item_id FROM edges WHERE user_id = {RANK_TARGET})),
top AS (SELECT item_id, score, row_number() OVER (ORDER BY score DESC, CAST(item_id AS VARCHAR)) AS rank
        FROM cand ORDER BY rank LIMIT 10)
SELECT '{RANK_TARGET}' || chr(9) ||
       string_agg(CAST(item_id AS VARCHAR) || ':' || {O.fixed('score', 3)}, ',' ORDER BY rank) AS value
FROM top""")
def q_run_rank(spark, sf_dir):
    train, test = _text_files(spark, sf_dir)
    return J.run_rank(spark, train, test, scratch_path(spark, "job-rank"), RANK_TARGET).result


# ------------------------------------------------------------- sink round trips

def _round_trip(spark, writer, df, name):
    path = scratch_path(spark, name)
    writer(df, path)
    return spark.read.text(path)


@register("write_clean_log", O.CLEAN + """
SELECT concat_ws(',', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR), CAST(category_id AS VARCHAR),
                 behavior_type, CAST(ts AS VARCHAR)) AS value FROM clean""")
def q_write_clean_log(spark, sf_dir):
    return _round_trip(spark, SK.write_clean_log, _clean(spark, sf_dir), "sink-clean-log")


@register("write_user_features", O.NORM + f"""
SELECT CAST(user_id AS VARCHAR) || ',' || {O.fixed('f1', 4)} || ',' || {O.fixed('f2', 4)} || ','
       || {O.fixed('f3', 4)} AS value FROM norm""")
def q_write_user_features(spark, sf_dir):
    return _round_trip(spark, SK.write_user_features,
                       FT.normalized_user_features(_clean(spark, sf_dir)), "sink-features")


@register("write_inverted_index", O.DEEP + """
SELECT CAST(item_id AS VARCHAR) || chr(9) || string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS value
FROM edges GROUP BY item_id""")
def q_write_inverted_index(spark, sf_dir):
    return _round_trip(spark, SK.write_inverted_index, CO.inverted_index(_written_edges(spark, sf_dir)),
                       "sink-index")


@register("write_cooccurrence", O.PAIRS + """
SELECT printf('%d,%d', item_a, item_b) || chr(9) || CAST(n_users AS VARCHAR) AS value
FROM (SELECT * FROM cooc ORDER BY n_users DESC, item_a, item_b LIMIT 1000)""")
def q_write_cooccurrence(spark, sf_dir):
    return _round_trip(spark, SK.write_cooccurrence,
                       CO.top_item_pairs(CO.item_cooccurrence(_written_edges(spark, sf_dir))), "sink-pairs")


@register("write_centres", O.kmeans_loop() + f"""
SELECT CAST(cluster_id AS VARCHAR) || chr(9) || {O.fixed('f1', 4)} || ',' || {O.fixed('f2', 4)} || ','
       || {O.fixed('f3', 4)} AS value FROM centres""")
def q_write_centres(spark, sf_dir):
    return _round_trip(spark, SK.write_centres, _kmeans(spark, sf_dir).centres_frame(spark), "sink-centres")


@register("write_labels", O.kmeans_loop() + """
SELECT CAST(user_id AS VARCHAR) || ',' || CAST(cluster_id AS VARCHAR) AS value FROM labels""")
def q_write_labels(spark, sf_dir):
    return _round_trip(spark, SK.write_labels, _kmeans(spark, sf_dir).labels, "sink-labels")


# ------------------------------------------------------------ scalar functions

_DAY_REF = 1706745600  # 2024-02-01T00:00:00Z, a fixed cut-off for day_difference


@register("scalar_functions", O.EV + f""",
x AS (SELECT ev.*, concat_ws(',', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR), CAST(category_id AS VARCHAR),
                             behavior_type, CAST(ts AS VARCHAR)) AS line,
             chr(9) || ' ' || upper(behavior_type) || ' ' || chr(10) AS padded,
             value AS amount
      FROM ev JOIN (SELECT event_id, value FROM events) USING (event_id))
SELECT event_id,
       starts_with(line, 'user_id') AS is_header,
       lower({O._jtrim('padded')}) AS behavior_trimmed,
       {O._int_parse("string_split(line, ',')[1]", 'BIGINT')} AS user_parsed,
       {O._int_parse("string_split(line, ',')[6]", 'BIGINT')} AS past_end,
       {O.WEIGHT} AS weight,
       (CAST({_DAY_REF} AS BIGINT) - ts) / 86400.0 AS days_before,
       CASE WHEN 1000.0 = 0.0 THEN 0.5 ELSE (amount - 0.0) / (1000.0 - 0.0) END AS amount_scaled,
       sqrt((amount - 0.0) * (amount - 0.0) + (CAST(item_id AS DOUBLE) - 0.0) * (CAST(item_id AS DOUBLE) - 0.0)) AS dist,
       {O.fixed('amount', 4)} AS amount_text,
       'I_' || CAST(item_id AS VARCHAR) AS node,
       item_id AS node_id_back
FROM x""")
def q_scalar_functions(spark, sf_dir):
    ev = _log(spark, sf_dir)
    amount = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.col("value").alias("amount"))
    x = ev.join(amount, "event_id").withColumn(
        "line", F.concat_ws(",", *[F.col(c).cast("string") for c in C.LOG_COLUMNS])).withColumn(
        "padded", F.concat(F.lit("\t "), F.upper("behavior_type"), F.lit(" \n")))
    parts = F.split("line", ",", -1)
    node = FN.node_name(F.lit(1), F.col("item_id"))
    return x.select(
        "event_id",
        F.col("line").startswith("user_id").alias("is_header"),
        F.lower(FN.java_trim("padded")).alias("behavior_trimmed"),
        FN.parse_long(FN.split_field(parts, 0)).alias("user_parsed"),
        FN.parse_long(FN.split_field(parts, 5)).alias("past_end"),
        FN.behavior_weight("behavior_type").alias("weight"),
        FN.day_difference(F.lit(_DAY_REF).cast("bigint"), F.col("ts")).alias("days_before"),
        FN.min_max_scale("amount", F.lit(0.0), F.lit(1000.0)).alias("amount_scaled"),
        FN.euclidean_distance([F.col("amount"), F.col("item_id").cast("double")],
                              [F.lit(0.0), F.lit(0.0)]).alias("dist"),
        FN.format_fixed("amount", 4).alias("amount_text"),
        node.alias("node"),
        FN.node_kind_id(node)[1].alias("node_id_back"),
    )


@register("recommend_stats", _TOP + """
SELECT min(target_id) AS target_id, round(max(score), 9) AS top_score, max(score) < 0.0005 AS low_score,
       count(*) AS n_recommended FROM top""")
def q_recommend_stats(spark, sf_dir):
    recs = RK.recommend_top_k(_walk(spark, sf_dir), _edges(spark, sf_dir), RANK_TARGET)
    st = RK.recommend_stats(recs)
    return st.select("target_id", _r9("top_score"), "low_score", "n_recommended")


@register("read_user_features", O.NORM + """
SELECT user_id, f1, f2, f3 FROM norm""")
def q_read_user_features(spark, sf_dir):
    path = scratch_path(spark, "features-text")
    SK.write_user_features(FT.normalized_user_features(_clean(spark, sf_dir)), path)
    return TX.read_user_features(spark, path)


@register("write_recommendations", _TOP + f"""
SELECT CAST(min(target_id) AS VARCHAR) || chr(9) ||
       string_agg(CAST(item_id AS VARCHAR) || ':' || {O.fixed('score', 3)}, ',' ORDER BY rank) AS value
FROM top""")
def q_write_recommendations(spark, sf_dir):
    recs = RK.recommend_top_k(_walk(spark, sf_dir), _edges(spark, sf_dir), RANK_TARGET)
    return _round_trip(spark, SK.write_recommendations, RK.recommendation_line(recs), "sink-recommendations")


@register("line_stats", O.LINES + f""",
cls AS (SELECT value, starts_with(value, 'user_id') AS is_header,
               NOT starts_with(value, 'user_id') AND {O._jtrim('value')} = '' AS is_blank FROM lines)
SELECT count(*) AS n_lines,
       count(*) FILTER (WHERE is_header) AS n_header,
       count(*) FILTER (WHERE is_blank) AS n_blank,
       count(*) FILTER (WHERE NOT is_header AND NOT is_blank) AS n_data,
       (SELECT count(*) FROM typed WHERE n < 5) AS n_rejected_arity,
       (SELECT count(*) FROM typed WHERE n >= 5 AND (user_id IS NULL OR item_id IS NULL OR ts IS NULL
                                                    OR category_id IS NULL)) AS n_rejected_number,
       (SELECT count(*) FROM typed WHERE n >= 5 AND user_id IS NOT NULL AND item_id IS NOT NULL
                                    AND ts IS NOT NULL AND category_id IS NOT NULL) AS n_parsed
FROM cls""")
def q_line_stats(spark, sf_dir):
    return TX.line_stats(_lines(spark, sf_dir))


@register("route_lines", O.parsed() + f""",
routed AS (
  SELECT 'log' AS route, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS value, user_id, item_id, category_id, behavior_type, ts FROM parsed
  UNION ALL SELECT 'rejected', reason, value, NULL, NULL, NULL, NULL, NULL FROM rejected
  UNION ALL SELECT CASE WHEN starts_with(value, 'user_id') THEN 'header' ELSE 'blank' END, NULL, value, NULL, NULL, NULL, NULL, NULL
  FROM lines WHERE starts_with(value, 'user_id') OR {O._jtrim('value')} = '')
SELECT route, reason, value, user_id, item_id, category_id, behavior_type, ts FROM routed""")
def q_route_lines(spark, sf_dir):
    # the folders of one parse, put together again
    r = TX.write_routes(_lines(spark, sf_dir))
    typed = ["user_id", "item_id", "category_id", "behavior_type", "ts"]
    parts = [r.log.withColumns({"route": F.lit(TX.LOG), "reason": F.lit(None).cast("string"), "value": F.lit(None).cast("string")})]
    for route, df in ((TX.REJECTED, r.rejected), (TX.HEADER, r.header), (TX.BLANK, r.blank)):
        parts.append(df.withColumn("route", F.lit(route)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select("route", "reason", "value", *typed)


def _state(spark, sf_dir) -> str:
    # the train split first; the second refresh reads the test split only
    train, test = _text_files(spark, sf_dir)
    state = scratch_path(spark, "user-state")
    ST.refresh(spark, state, {"train": train})
    ST.refresh(spark, state, {"train": train, "test": test})
    return state


@register("incremental_features", O.NORM_TEXT + """
SELECT user_id, f1, f2, f3 FROM norm""")
def q_incremental_features(spark, sf_dir):
    return ST.features(spark, _state(spark, sf_dir))


@register("state_lineage", O.parsed() + """,
per AS (SELECT split, count(*) AS n_lines FROM lines GROUP BY split)
SELECT CASE split WHEN 'train' THEN 1 ELSE 2 END::BIGINT AS run, split, 1 AS version, n_lines,
       (SELECT count(*) FROM parsed p WHERE p.split = per.split) AS n_records FROM per""")
def q_state_lineage(spark, sf_dir):
    return ST.lineage(spark, _state(spark, sf_dir)).select("run", "split", "version", "n_lines", "n_records")


# ------------------------------------------ larger graph, large ids, hot keys

_LARGE = """,
large AS (SELECT DISTINCT user_id * 4194304 + 5 AS user_id, item_id * 1099511627776 + 7 AS item_id FROM edges)"""


def _large_edges(spark, sf_dir):
    # ids far apart: neighbours in a list differ by more than any fixed id range
    return _written_edges(spark, sf_dir).select((F.col("user_id") * 4194304 + 5).alias("user_id"),
                                                (F.col("item_id") * 1099511627776 + 7).alias("item_id"))


@register("inverted_index_large_ids", O.DEEP + _LARGE + """
SELECT item_id, count(*) AS n_users, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS user_ids
FROM large GROUP BY item_id""")
def q_inverted_index_large_ids(spark, sf_dir):
    return _index_rows(CO.inverted_index(_large_edges(spark, sf_dir)))


@register("user_baskets_large_ids", O.DEEP + _LARGE + """
SELECT user_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS item_ids
FROM large GROUP BY user_id""")
def q_user_baskets_large_ids(spark, sf_dir):
    return _basket_rows(CO.user_baskets(_large_edges(spark, sf_dir)))


@register("inverted_index_split_lists", O.DEEP + """
SELECT item_id, count(*) AS n_users, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS user_ids, count(*) > 8 AS is_split
FROM edges GROUP BY item_id""")
def q_inverted_index_split_lists(spark, sf_dir):
    # every list above 8 users is cut into segments, which in order are the whole sorted list
    idx = materialize(CO.inverted_index(_written_edges(spark, sf_dir), max_list=8), "split-index")
    parts = idx.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("block", "user_ids"))).alias("p"))
    whole = F.flatten(F.transform("p", lambda x: x["user_ids"]))
    return parts.select("item_id", F.size(whole).cast("bigint").alias("n_users"), _list_text(whole).alias("user_ids"),
                        (F.size("p") > 1).alias("is_split"))


@register("write_cooccurrence_ordered", O.lineitem(O.PAIRS) + """
SELECT row_number() OVER (ORDER BY n_users DESC, item_a, item_b) - 1 AS line,
       printf('%d,%d', item_a, item_b) || chr(9) || CAST(n_users AS VARCHAR) AS value FROM cooc""")
def q_write_cooccurrence_ordered(spark, sf_dir):
    # line numbers as read: files in name order, each line by line
    path, own = scratch_path(spark, "sink-cooccurrence-ordered"), tidy_session(spark)
    pairs = CO.item_cooccurrence(_lineitem_edges(own, sf_dir))
    index = materialize(SK.write_cooccurrence_ordered(pairs, path, compression="gzip"), "pair-index")
    return SK.read_ordered_lines(spark, path, index)


@register("inverted_index_lineitem", O.lineitem(O.DEEP) + """
SELECT item_id, count(*) AS n_users, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS user_ids
FROM edges GROUP BY item_id""")
def q_inverted_index_lineitem(spark, sf_dir):
    return _index_rows(CO.inverted_index(_lineitem_edges(spark, sf_dir)))


@register("pair_histogram_lineitem", O.lineitem(O.PAIRS) + """
SELECT n_users, count(*) AS n_pairs, sum(item_a % 1000 + item_b % 1000)::BIGINT AS id_sum FROM cooc GROUP BY n_users""")
def q_pair_histogram_lineitem(spark, sf_dir):
    return CO.item_cooccurrence(_lineitem_edges(spark, sf_dir)).groupBy("n_users").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.sum(F.col("item_a") % 1000 + F.col("item_b") % 1000).alias("id_sum"))


@register("top_item_pairs_lineitem", O.lineitem(O.PAIRS) + """
SELECT item_a, item_b, n_users FROM cooc ORDER BY n_users DESC, item_a, item_b LIMIT 1000""")
def q_top_item_pairs_lineitem(spark, sf_dir):
    return CO.top_item_pairs_pruned(_lineitem_edges(spark, sf_dir))


@register("top_item_pairs_pruned_pass", O.lineitem(O.PAIRS) + """
SELECT item_a, item_b, n_users FROM cooc ORDER BY n_users DESC, item_a, item_b LIMIT 5""")
def q_top_item_pairs_pruned_pass(spark, sf_dir):
    # few pairs wanted: the bound of the first pass leaves rare items out of the second
    return CO.top_item_pairs_pruned(_lineitem_edges(spark, sf_dir), limit=5)


@register("user_features_norm_lineitem", O.lineitem(O.NORM) + """
SELECT user_id, f1, f2, f3 FROM norm""")
def q_user_features_norm_lineitem(spark, sf_dir):
    return FT.normalized_user_features(C.clean_behavior_log(A.lineitem_behavior_log(spark, sf_dir)))


@register("personal_rank_lineitem", O.lineitem(O.rank_walk()) + """
SELECT kind, id, round(score, 9) AS score FROM final WHERE score <> 0""")
def q_personal_rank_lineitem(spark, sf_dir):
    return RK.personal_rank(RK.bipartite_edges(_lineitem_edges(spark, sf_dir)), RANK_TARGET).scores.select("kind", "id", _r9("score"))


@register("personal_rank_salted", O.rank_walk() + """
SELECT kind, id, round(score, 9) AS score FROM final WHERE score <> 0""")
def q_personal_rank_salted(spark, sf_dir):
    # every node above 4 edges salted, the vector shuffled into the buckets, old turns dropped
    return RK.personal_rank(_graph(spark, sf_dir), RANK_TARGET, block_size=4, broadcast_rows=0, partitions=3,
                            keep_turns=False).scores.select("kind", "id", _r9("score"))


@register("adjacency_blocks", O.GRAPH + """
SELECT nodes.kind, nodes.id, count(bi.src_id) AS out_deg, greatest(1, CAST(ceil(count(bi.src_id) / 4.0) AS BIGINT)) AS n_salts,
       string_agg(CAST(dst_kind AS VARCHAR) || ':' || CAST(dst_id AS VARCHAR), ',' ORDER BY dst_kind, dst_id) AS dsts
FROM nodes LEFT JOIN bi ON bi.src_kind = nodes.kind AND bi.src_id = nodes.id GROUP BY nodes.kind, nodes.id""")
def q_adjacency_blocks(spark, sf_dir):
    # nodes above 4 edges in salted blocks; the blocks of a node rejoin to its list
    graph = _graph(spark, sf_dir)
    nodes = materialize(RK.node_table(graph, 4), "rank-nodes")
    blocks = RK.adjacency_blocks(graph, nodes, 4, RK.heavy_nodes(nodes, 4))
    lists = blocks.groupBy(F.col("src_kind").alias("kind"), F.col("src_id").alias("id")).agg(
        F.max("out_deg").alias("out_deg"), F.array_sort(F.flatten(F.collect_list("dsts"))).alias("d"))
    entry = F.transform("d", lambda x: F.concat_ws(":", x["kind"].cast("string"), x["id"].cast("string")))
    return lists.join(nodes.select("kind", "id", F.col("nsalt").cast("long").alias("n_salts")), ["kind", "id"]).select(
        "kind", "id", "out_deg", "n_salts", F.array_join(entry, ",").alias("dsts"))


_WALKS_MEMO: dict = {}


def _walks(spark, sf_dir) -> RK.WalksResult:
    key = _listing(spark, sf_dir)
    if key not in _WALKS_MEMO:
        edges = _written_edges(spark, sf_dir)
        targets = [r[0] for r in edges.select("user_id").distinct().orderBy("user_id").limit(O.N_TARGETS).collect()]
        _WALKS_MEMO[key] = edges, RK.walks(RK.bipartite_edges(edges), targets)
    return _WALKS_MEMO[key]


@register("personal_rank_targets", O.rank_walks() + """
SELECT target, kind, id, round(score, 9) AS score FROM final WHERE score <> 0""")
def q_personal_rank_targets(spark, sf_dir):
    return _walks(spark, sf_dir)[1].scores.select("target", "kind", "id", _r9("score"))


@register("personal_rank_targets_turns", O.rank_walks() + """
SELECT target, turn::BIGINT AS turns FROM stop""")
def q_personal_rank_targets_turns(spark, sf_dir):
    return spark.createDataFrame(list(_walks(spark, sf_dir)[1].iterations.items()), "target long, turns long")


@register("recommend_many", O.rank_walks() + """,
cand AS (SELECT t.target, n.id AS item_id, coalesce(f.score, 0.0) AS score
         FROM nodes n CROSS JOIN targets t LEFT JOIN final f ON f.kind = 1 AND f.id = n.id AND f.target = t.target
         WHERE n.kind = 1 AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.user_id = t.target AND e.item_id = n.id))
SELECT target AS target_id, CAST(row_number() OVER (PARTITION BY target ORDER BY score DESC, CAST(item_id AS VARCHAR)) AS INTEGER) AS rank,
       item_id, round(score, 9) AS score FROM cand QUALIFY rank <= 10""")
def q_recommend_many(spark, sf_dir):
    edges, walks = _walks(spark, sf_dir)
    return RK.recommend_many(walks, edges).select("target_id", "rank", "item_id", _r9("score"))


# ------------------------------------------------- damaged features, seeded start

@register("parse_user_features_damaged", O.DAMAGED_FEATURES)
def q_parse_user_features_damaged(spark, sf_dir):
    t = {c: F.format_string("%.4f", c) for c in ("f1", "f2", "f3")}
    u, d = F.col("user_id").cast("string"), F.col("user_id") % 12
    kinds = [F.concat_ws(",", u, t["f1"])] + [F.concat_ws(",", u, F.lit(w), t["f2"], t["f3"])
                                              for w in ("x", "inf", "nan", "NaN", "-Infinity")]
    kinds += [F.concat_ws(",", u, *t.values(), F.lit("extra")),
              F.concat(F.lit(" "), u, F.lit(" , "), t["f1"], F.lit(" ,"), t["f2"], F.lit(","), t["f3"]),
              F.concat_ws(",", F.concat(u, F.lit(".5")), *t.values()), F.concat_ws(",", u, t["f1"], F.lit("-Inf"), t["f3"])]
    value = F.concat_ws(",", u, *t.values())
    for i, k in enumerate(kinds):
        value = F.when(d == i, k).otherwise(value)
    path = scratch_path(spark, "features-damaged")
    FT.normalized_user_features(_clean(spark, sf_dir)).select(value.alias("value")).write.text(path)
    got = TX.read_user_features(spark, path)
    inf = float("inf")

    def shown(c):
        return (F.when(F.isnan(c), "NaN").when(F.col(c) == inf, "Infinity").when(F.col(c) == -inf, "-Infinity")
                .otherwise(F.format_string("%.4f", c)).alias(c))

    return got.select("user_id", *[shown(c) for c in ("f1", "f2", "f3")])


@register("init_centres_seeded", O.POINTS + f"""
SELECT cluster_id, f1, f2, f3 FROM {O.SEEDED_INIT}""")
def q_init_centres_seeded(spark, sf_dir):
    return KM.centres_frame(spark, KM.init_centres(_points(spark, sf_dir), 3, method="seeded"))


@register("kmeans_seeded", O.kmeans_loop(init=O.SEEDED_INIT) + """
SELECT cluster_id, round(f1, 9) AS f1, round(f2, 9) AS f2, round(f3, 9) AS f3 FROM centres""")
def q_kmeans_seeded(spark, sf_dir):
    return KM.kmeans(_points(spark, sf_dir), init="seeded").centres_frame(spark).select(
        "cluster_id", _r9("f1"), _r9("f2"), _r9("f3"))


# ------------------------------------------------------------- run statistics

def _union_metrics(with_sql: str, **metrics: str) -> str:
    """Metric rows: each value is ``expression FROM ...`` over the CTEs of ``with_sql``."""
    return with_sql + "\n" + "\nUNION ALL ".join(
        f"SELECT '{k}' AS metric, round(CAST({v.split(' FROM ', 1)[0]} AS DOUBLE), 6) AS value FROM {v.split(' FROM ', 1)[1]}"
        for k, v in metrics.items())


def _rounded(stats):
    return stats.select("metric", F.round("value", 6).alias("value"))


@register("run_features_stats", _union_metrics(
    O.NORM_TEXT, n_lines="count(*) FROM lines", n_rejected="count(*) FROM rejected", n_train_rows="count(*) FROM src WHERE split = 'train'", n_test_rows="count(*) FROM src WHERE split = 'test'",
    n_clean_rows="count(*) FROM clean", max_ts="max(ts) FROM clean", n_users="count(*) FROM agg",
    **{f"{c}_{f}": f"{f}({c}) FROM feat" for c in ("recency_days", "activity_count", "value_score") for f in ("min", "max")}))
def q_run_features_stats(spark, sf_dir):
    train, test = _text_files(spark, sf_dir)
    return _rounded(J.run_features(spark, train, test, scratch_path(spark, "job-features")).stats)


@register("run_cooccurrence_stats", _union_metrics(
    O.PAIRS_TEXT, n_lines="count(*) FROM lines", n_deep_rows="count(*) FROM deep", n_edges="count(*) FROM edges",
    n_items="count(DISTINCT item_id) FROM edges", n_users="count(DISTINCT user_id) FROM edges", n_pairs="count(*) FROM cooc"))
def q_run_cooccurrence_stats(spark, sf_dir):
    train, test = _text_files(spark, sf_dir)
    return _rounded(J.run_cooccurrence(spark, train, test, scratch_path(spark, "job-cooccurrence")).stats)


@register("run_clustering_stats", _union_metrics(
    O.kmeans_loop_text(), n_train_users="count(*) FROM train_users", n_clustered_users="count(*) FROM pts",
    iterations="turn FROM kstop", **{f"n_cluster_{i}": f"count(*) FROM labels WHERE cluster_id = {i}" for i in range(3)}))
def q_run_clustering_stats(spark, sf_dir):
    train, test = _text_files(spark, sf_dir)
    feats = J.run_features(spark, train, test, scratch_path(spark, "job-features")).paths["features"]
    clean_train, _ = _clean_text_files(spark, sf_dir)
    return _rounded(J.run_clustering(spark, feats, scratch_path(spark, "job-clustering"), clean_train).stats)


@register("run_rank_stats", _union_metrics(
    O.rank_walk_text() + f""",
top_score AS (SELECT coalesce(max(f.score), 0.0) AS score FROM nodes n LEFT JOIN final f ON f.kind = 1 AND f.id = n.id
              WHERE n.kind = 1 AND n.id NOT IN (SELECT item_id FROM edges WHERE user_id = {RANK_TARGET}))""",
    n_nodes="count(*) FROM nodes", n_users="count(*) FROM nodes WHERE kind = 0", n_items="count(*) FROM nodes WHERE kind = 1",
    n_edges="count(*) FROM bi", iterations="turn FROM stop",
    target_in_graph=f"count(*) FROM nodes WHERE kind = 0 AND id = {RANK_TARGET}",
    top_score="score FROM top_score", low_score="(score < 0.0005)::INT FROM top_score"))
def q_run_rank_stats(spark, sf_dir):
    train, test = _text_files(spark, sf_dir)
    return _rounded(J.run_rank(spark, train, test, scratch_path(spark, "job-rank"), RANK_TARGET).stats)
