"""Command line for the four jobs (use with spark-submit or python -m).

    python -m cartograph features    TRAIN TEST OUT
    python -m cartograph cooccurrence TRAIN [TEST] OUT
    python -m cartograph clustering  FEATURES OUT TRAIN [--k 3]
    python -m cartograph rank        TRAIN [TEST] OUT --target ID [ID ...] [--top-k 10]

With a single input file the co-occurrence and rank jobs read it as both
splits (its rows are counted twice; results are unchanged by the distinct
edges).
"""

from __future__ import annotations

import argparse
import sys

from cartograph.plans import jobs
from cartograph.schema import KMEANS_K, RANK_TOP_K, TOP_PAIRS
from cartograph.session import get_session


def _split_args(paths: list[str]) -> tuple[str, str | None, str]:
    if len(paths) == 3:
        return paths[0], paths[1], paths[2]
    if len(paths) == 2:
        return paths[0], None, paths[1]
    raise SystemExit("expected TRAIN [TEST] OUT")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cartograph")
    sub = ap.add_subparsers(dest="job", required=True)
    f = sub.add_parser("features")
    f.add_argument("train")
    f.add_argument("test")
    f.add_argument("out")
    c = sub.add_parser("cooccurrence")
    c.add_argument("paths", nargs="+")
    c.add_argument("--limit", type=int, default=TOP_PAIRS, help="rows of the report; they end in one file")
    k = sub.add_parser("clustering")
    k.add_argument("features")
    k.add_argument("out")
    k.add_argument("train")
    k.add_argument("--k", type=int, default=KMEANS_K)
    r = sub.add_parser("rank")
    r.add_argument("paths", nargs="+")
    r.add_argument("--target", type=int, required=True, nargs="+", help="several targets walk in one loop, a line each")
    r.add_argument("--top-k", type=int, default=RANK_TOP_K)
    args = ap.parse_args(argv)

    spark = get_session(app_name=f"cartograph-{args.job}")
    if args.job == "features":
        out = jobs.run_features(spark, args.train, args.test, args.out)
    elif args.job == "cooccurrence":
        train, test, dest = _split_args(args.paths)
        out = jobs.run_cooccurrence(spark, train, test, dest, limit=args.limit)
    elif args.job == "clustering":
        out = jobs.run_clustering(spark, args.features, args.out, args.train, k=args.k)
    else:
        train, test, dest = _split_args(args.paths)
        out = jobs.run_rank(spark, train, test, dest, target=args.target if len(args.target) > 1 else args.target[0], k=args.top_k)
    for name, value in out.paths.items():
        print(f"{name}: {value}")
    for r in out.stats.orderBy("metric").collect():  # a few dozen counts at most
        print(f"{r.metric}: {r.value:.10g}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
