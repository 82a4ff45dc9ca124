"""Benchmark the headline queries.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line with per-query seconds.
Each query is forced completely with a ``noop`` write (every row computed,
nothing collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cartograph.operators import clean as C  # noqa: E402
from cartograph.operators import cluster as KM  # noqa: E402
from cartograph.operators import cooccur as CO  # noqa: E402
from cartograph.operators import features as FT  # noqa: E402
from cartograph.operators import rank as RK  # noqa: E402
from cartograph.session import get_session, materialize  # noqa: E402
from cartograph.sources import adapters as A  # noqa: E402
from cartograph.sources import text as TX  # noqa: E402


def force(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_session(f"local[{cpus}]", app_name="cartograph-bench", shuffle_partitions=int(cpus) * 2,
                        conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    # untimed JVM warm-up (class loading, first code generation), not an operator
    spark.range(10000).groupBy((F.col("id") % 7).alias("k")).count().collect()
    spark.read.parquet(f"{sf_dir}/region.parquet").collect()

    def ev_log():
        return A.events_behavior_log(spark, sf_dir)

    def li_log():
        return A.lineitem_behavior_log(spark, sf_dir)

    def features_events():
        force(FT.normalized_user_features(C.clean_behavior_log(ev_log())))

    def features_lineitem():
        force(FT.normalized_user_features(C.clean_behavior_log(li_log())))

    def parse_text_log():
        lines = materialize(A.damaged_log_lines(spark, sf_dir), "bench-lines")
        force(C.clean_behavior_log(TX.parse_behavior_lines(lines)))

    def inverted_index_lineitem():
        force(CO.inverted_index(materialize(CO.interaction_edges(li_log()), "bench-edges")))

    def top_pairs_lineitem():
        edges = materialize(CO.interaction_edges(li_log()), "bench-edges")
        force(CO.top_item_pairs(CO.item_cooccurrence(edges)))

    def cooccurrence_lineitem():
        force(CO.item_cooccurrence(materialize(CO.interaction_edges(li_log()), "bench-edges")))

    def kmeans_events():
        feats = FT.normalized_user_features(C.clean_behavior_log(ev_log()))
        users = TX.parse_user_ids(A.log_lines(ev_log().where("split = 'train'")))
        res = KM.kmeans(KM.restrict_to_users(feats, users))
        force(res.labels)

    def rank_events():
        edges = materialize(CO.interaction_edges(ev_log()), "bench-edges")
        res = RK.personal_rank(RK.bipartite_edges(edges), 1)
        force(RK.recommend_top_k(res, edges, 1))

    def rank_lineitem():
        edges = materialize(CO.interaction_edges(li_log()), "bench-edges")
        target = edges.agg(F.min("user_id")).first()[0]
        res = RK.personal_rank(RK.bipartite_edges(edges), target)
        force(RK.recommend_top_k(res, edges, target))

    plan = [
        ("features_events", features_events),
        ("features_lineitem", features_lineitem),
        ("parse_text_log", parse_text_log),
        ("inverted_index_lineitem", inverted_index_lineitem),
        ("top_pairs_lineitem", top_pairs_lineitem),
        ("cooccurrence_lineitem", cooccurrence_lineitem),
        ("kmeans_events", kmeans_events),
        ("rank_events", rank_events),
        ("rank_lineitem", rank_lineitem),
    ]
    only = set(sys.argv[1:])
    times = {}
    for name, fn in plan:
        if only and name not in only:
            continue
        t = time.time()
        fn()
        times[name] = round(time.time() - t, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
