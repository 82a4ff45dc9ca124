"""Write the physical plans of the headline operators to docs/PLANS.md.

usage: python tools/explain_plans.py [sf_dir]
Plans are printed after execution, so they are AQE's final plans.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from cartograph.operators import clean as C  # noqa: E402
from cartograph.operators import cluster as KM  # noqa: E402
from cartograph.operators import cooccur as CO  # noqa: E402
from cartograph.operators import features as FT  # noqa: E402
from cartograph.operators import rank as RK  # noqa: E402
from cartograph.session import get_session, materialize  # noqa: E402
from cartograph.sources import adapters as A  # noqa: E402
from cartograph.sources import text as TX  # noqa: E402


def plan_of(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().strip()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    ev = A.events_behavior_log(spark, sf_dir)
    li = A.lineitem_behavior_log(spark, sf_dir)
    sections = []

    agg = FT.user_aggregate(C.clean_behavior_log(ev))
    sections.append(("T1 per-user aggregate (written once by normalized_user_features)", plan_of(agg)))
    sections.append(("T1 scaled features (bounds are literals)",
                     plan_of(FT.normalized_user_features(C.clean_behavior_log(ev)))))

    lines = materialize(A.damaged_log_lines(spark, sf_dir), "plan-lines")
    sections.append(("Text parse + clean", plan_of(C.clean_behavior_log(TX.parse_behavior_lines(lines)))))

    edges = materialize(CO.interaction_edges(li), "plan-edges")
    sections.append(("T2 inverted index (lineitem adapter)", plan_of(CO.inverted_index(edges))))
    sections.append(("T2 top pairs over all pair counts (lineitem adapter)",
                     plan_of(CO.top_item_pairs(CO.item_cooccurrence(edges)))))

    deg = materialize(CO.item_degrees(edges), "plan-degrees")
    head = deg.orderBy(F.col("n_users").desc(), "item_id").limit(180).select("item_id")
    sections.append(("T2 pruned top pairs, first pass (pairs among the most shared items)",
                     plan_of(CO.item_cooccurrence(edges.join(F.broadcast(head), "item_id", "left_semi")))))
    often = deg.where(F.col("n_users") >= 2).select("item_id")
    sections.append(("T2 pruned top pairs, second pass (pairs among items at the first pass's bound)",
                     plan_of(CO.item_cooccurrence(edges.join(often, "item_id", "left_semi")))))

    pts = materialize(FT.normalized_user_features(C.clean_behavior_log(ev)), "plan-points")
    centres = KM.init_centres(pts, 3)
    sections.append(("T3 one k-means turn (K literal centres)", plan_of(KM.cluster_sums(pts, centres))))

    captured = []
    kind = type(spark)
    orig = kind.sql

    def spy(session, q, *a, **k):  # the loop runs in a session of its own
        df = orig(session, q, *a, **k)
        if "sum(rst)" in q and len(captured) < 3:
            captured.append(plan_of(df))
        return df

    kind.sql = spy
    try:
        e2 = materialize(CO.interaction_edges(li), "plan-edges")
        RK.personal_rank(RK.bipartite_edges(e2), 1, max_iter=3)
        broadcast_turn = captured[1]
        captured.clear()
        RK.personal_rank(RK.bipartite_edges(e2), 1, max_iter=2, broadcast_rows=0)
        shuffled_turn = captured[1]
    finally:
        kind.sql = orig
    sections.append(("T4 rank turn, vector broadcast (turn 2)", broadcast_turn))
    sections.append(("T4 rank turn, vector shuffled into the edge buckets (turn 2)", shuffled_turn))

    out = ["# Physical plans", "",
           f"Generated by `tools/explain_plans.py {sf_dir}` (local[8], 16 shuffle partitions, AQE final plans).", ""]
    for title, plan in sections:
        out += [f"## {title}", "", "```", plan, "```", ""]
    os.makedirs(os.path.join(ROOT, "docs"), exist_ok=True)
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        # literals in a plan may hold control characters (the trim set): shown escaped, so the file stays text
        fh.write("".join(c if c in "\n\t" or ord(c) >= 32 else f"\\u{ord(c):04x}" for c in "\n".join(out)))
    print("wrote docs/PLANS.md")


if __name__ == "__main__":
    main()
