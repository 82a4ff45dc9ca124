from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartograph.operators import rank as R

# fixed values: a published component, its isolated items and its published line
CORE = [(80444, 4826576), (431070, 4826576), (534266, 4826576), (431070, 1503068), (769575, 1503068)]
ISOLATED = [1000436, 1000531, 1000993, 1001604, 1002659, 1002805, 1003035, 1003282, 1003640, 1004488]
GOLDEN = ("534266\t1503068:0.096,1000436:0.000,1000531:0.000,1000993:0.000,1001604:0.000,"
          "1002659:0.000,1002805:0.000,1003035:0.000,1003282:0.000,1003640:0.000")


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "user_id long, item_id long")


@pytest.fixture(scope="module")
def golden(spark):
    e = _edges(spark, CORE + [(900000 + i, it) for i, it in enumerate(ISOLATED)])
    return e, R.personal_rank(R.bipartite_edges(e), 534266)


def test_golden_line(spark, golden):
    e, res = golden
    assert res.iterations == 54 and res.converged
    line = R.recommendation_line(R.recommend_top_k(res, e, 534266)).first()[0]
    assert line == GOLDEN
    top = R.recommend_top_k(res, e, 534266).first()
    assert top.score == pytest.approx(0.0956027, abs=1e-7)


def test_scores_sum_to_one(spark, golden):
    _, res = golden
    assert sum(r.score for r in res.scores.collect()) == pytest.approx(1.0, abs=1e-12)


def test_unknown_target(spark, golden):
    e, _ = golden
    res = R.personal_rank(R.bipartite_edges(e), 1001)
    assert res.iterations == 1 and not res.target_in_graph
    recs = R.recommend_top_k(res, e, 1001).collect()
    assert [r.item_id for r in recs] == ISOLATED and all(r.score == 0.0 for r in recs)


def test_string_tie_break_and_short_list(spark):
    # target 1 holds item 5; items 9 and 10 are reached symmetrically
    e = _edges(spark, [(1, 5), (2, 5), (2, 9), (2, 10)])
    res = R.personal_rank(R.bipartite_edges(e), 1, max_iter=100)
    recs = R.recommend_top_k(res, e, 1).collect()
    assert [r.item_id for r in recs] == [10, 9]


def test_salted_walk_matches_plain(spark):
    e = _edges(spark, [(u, i) for u in range(1, 6) for i in range(10, 10 + u * 3)])
    a = R.personal_rank(R.bipartite_edges(e), 3, max_iter=8)
    b = R.personal_rank(R.bipartite_edges(e), 3, max_iter=8, block_size=2)
    c = R.personal_rank(R.bipartite_edges(e), 3, max_iter=8, block_size=2, broadcast_rows=0)
    sa = {(r.kind, r.id): r.score for r in a.scores.collect()}
    for other in (b, c):
        so = {(r.kind, r.id): r.score for r in other.scores.collect()}
        assert sa.keys() == so.keys()
        assert all(sa[k] == pytest.approx(so[k], abs=1e-12) for k in sa)
    # plain one-turn operator agrees with the loop's first turn
    g = R.bipartite_edges(e)
    step = {(r.kind, r.id): r.score for r in R.rank_step(g, R.rank_init(g, 3), 3).collect()}
    one = R.personal_rank(g, 3, max_iter=1)
    assert step == pytest.approx({(r.kind, r.id): r.score for r in one.scores.collect()})


def test_dangling_mass_directed(spark):
    e = _edges(spark, [(1, 10), (1, 11)])
    g = R.directed_edges(e)
    step = R.rank_step(g, R.rank_init(g, 1), 1)
    assert R.dangling_mass(step, g).first().dangling == pytest.approx(0.85)
    res = R.personal_rank(g, 1, max_iter=3)
    # mass that reaches items restarts at the target each turn
    assert sum(r.score for r in res.scores.collect()) == pytest.approx(1.0)


def test_golden_component_single_pair(spark):
    from cartograph.operators import cooccur as CO
    e = _edges(spark, CORE)
    assert [tuple(r) for r in CO.item_cooccurrence(e).collect()] == [(1503068, 4826576, 1)]
    idx = {r.item_id: r.user_ids for r in CO.inverted_index(e).collect()}
    assert idx == {4826576: [80444, 431070, 534266], 1503068: [431070, 769575]}
    baskets = {r.user_id: r.item_ids for r in CO.user_baskets(e).collect()}
    assert baskets[431070] == [1503068, 4826576]


def test_empty_graph(spark):
    e = _edges(spark, [])
    res = R.personal_rank(R.bipartite_edges(e), 1)
    assert res.iterations == 1 and res.converged and not res.target_in_graph
    assert R.recommend_top_k(res, e, 1).count() == 0


def test_loop_results_have_no_lineage(spark, golden):
    # the final vector is read back from a written table: nothing upstream is replayed after a loss
    _, res = golden
    plan = res.scores._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "Join" not in plan and "Aggregate" not in plan


def test_bucket_count_stays_legal():
    assert R.bucket_count(0, 8) == 1 and R.bucket_count(1000, 10_000) == 1
    assert R.bucket_count(10 ** 15, 1000) == R.MAX_BUCKETS <= 100_000
    assert R.bucket_count(4_000_000, 8) == 8


def test_closed_set_keeps_the_walk(spark):
    """The walk over the reached part alone equals plain power iteration on the whole graph."""
    pairs = [(1, 10), (1, 11), (2, 11), (2, 12), (3, 12)] + [(u, u + 100) for u in range(50, 80)]
    deg, nodes = {}, {}
    adj = [((0, u), (1, i)) for u, i in pairs] + [((1, i), (0, u)) for u, i in pairs]
    for a, _ in adj:
        deg[a] = deg.get(a, 0) + 1
    x = {(0, 1): 1.0}
    for _ in range(40):
        y = {(0, 1): 0.15}
        for a, b in adj:
            if a in x:
                y[b] = y.get(b, 0.0) + 0.85 * x[a] / deg[a]
        x = y
    for kw in ({}, {"broadcast_rows": 0, "keep_turns": False}):
        res = R.personal_rank(R.bipartite_edges(_edges(spark, pairs)), 1, max_iter=40, tol=0.0, **kw)
        got = {(r.kind, r.id): r.score for r in res.scores.collect()}
        assert got.keys() == x.keys() and all(got[k] == pytest.approx(x[k], abs=1e-12) for k in x)
    assert not [t for t in spark.catalog.listTables() if "rank" in t.name]


def test_loop_leaves_session_settings_alone(spark, golden):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    e, _ = golden
    R.personal_rank(R.bipartite_edges(e), 534266, max_iter=2, partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


PAIRS = [(u, i) for u in range(1, 24) for i in range(100, 140) if (u * 7 + i * 3) % 11 < 3] + [(50, 900), (51, 900), (51, 901), (60, 950)]


@pytest.fixture(scope="module")
def several(spark):
    e = _edges(spark, PAIRS).cache()
    targets = [*range(1, 18), 50, 60, 777]  # a small component, an item of one user, an unknown user
    return e, targets, R.walks(R.bipartite_edges(e), targets)


def _walk_by_hand(pairs, target, tol=1e-4, max_iter=100):
    """Plain power iteration: turns, changes and the sparse vector of one target."""
    adj = [((0, u), (1, i)) for u, i in pairs] + [((1, i), (0, u)) for u, i in pairs]
    deg = Counter(a for a, _ in adj)
    x, changes = ({(0, target): 1.0} if (0, target) in deg else {}), []
    while len(changes) < max_iter and (not changes or changes[-1] >= tol):
        y = Counter({(0, target): 0.15}) if x else Counter()
        for a, b in adj:
            if a in x:
                y[b] += 0.85 * x[a] / deg[a]
        changes.append(max((abs(y[v] - x.get(v, 0.0)) for v in y), default=0.0))
        x = dict(y)
    return changes, x


def test_several_targets_equal_single_walks(spark, several):
    e, targets, many = several
    assert len(targets) == 20 and len(set(many.iterations.values())) > 2
    scores = {}
    for r in many.scores.collect():
        scores.setdefault(r.target, {})[r.kind, r.id] = r.score
    for t in targets:
        changes, want = _walk_by_hand(PAIRS, t)
        assert many.iterations[t] == len(changes) and many.converged[t] and many.in_graph[t] == bool(want)
        assert many.changes[t] == pytest.approx(changes, abs=1e-12)
        assert scores.get(t, {}) == pytest.approx(want, abs=1e-12)
    one, mine = R.personal_rank(R.bipartite_edges(e), 50), many.of(50)
    assert (mine.iterations, mine.converged, mine.target_in_graph) == (one.iterations, one.converged, one.target_in_graph)


def test_recommend_many_equals_single(spark, several):
    e, targets, many = several
    got, items = {}, {i for _, i in PAIRS}
    for r in R.recommend_many(many, e).orderBy("target_id", "rank").collect():
        got.setdefault(r.target_id, []).append((r.rank, r.item_id, round(r.score, 9)))
    for t in targets:
        _, x = _walk_by_hand(PAIRS, t)
        new = sorted(items - {i for u, i in PAIRS if u == t}, key=lambda i: (-round(x.get((1, i), 0.0), 9), str(i)))
        assert got[t] == [(n + 1, i, round(x.get((1, i), 0.0), 9)) for n, i in enumerate(new[:10])]
    for t in (50, 777):
        assert got[t] == [(r.rank, r.item_id, round(r.score, 9)) for r in R.recommend_top_k(many.of(t), e, t).collect()]


def test_several_targets_in_groups(spark, several, monkeypatch):
    e, targets, many = several
    monkeypatch.setattr(R, "TARGETS_PER_WALK", 3)
    few = R.walks(R.bipartite_edges(e), targets[-5:], max_iter=12, block_size=4, broadcast_rows=0, partitions=3, keep_turns=False)
    for t in targets[-5:]:
        changes, want = _walk_by_hand(PAIRS, t, max_iter=12)
        assert few.iterations[t] == len(changes)
        assert {(r.kind, r.id): r.score for r in few.of(t).scores.collect()} == pytest.approx(want, abs=1e-12)


def test_one_job_a_turn_for_all_targets(spark, several):
    """Twenty targets take no more jobs than one."""
    e, targets, many = several
    sc, jobs = spark.sparkContext, {}
    for name, ts in (("one", targets[:1]), ("all", targets)):
        sc.setJobGroup(f"walks-{name}", "")
        R.walks(R.bipartite_edges(e), ts, max_iter=6, tol=0.0)
        jobs[name] = len(sc.statusTracker().getJobIdsForGroup(f"walks-{name}"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs["all"] <= jobs["one"] + 2


def _adjacency(spark, graph, block):
    nodes = R.node_table(graph, block).cache()
    return {(r.src_kind, r.src_id, r.salt): r for r in R.adjacency_blocks(graph, nodes, block, R.heavy_nodes(nodes, block)).collect()}


def test_adjacency_blocks(spark):
    graph = R.directed_edges(_edges(spark, [(1, i) for i in range(100)] + [(2, 5)]))
    plain, split = _adjacency(spark, graph, 1000), _adjacency(spark, graph, 16)
    assert [d.id for d in plain[0, 1, 0].dsts] == list(range(100)) and plain[0, 1, 0].out_deg == 100
    mine = [r for (kind, node, _), r in split.items() if (kind, node) == (0, 1)]
    assert len(mine) == 7 and sorted(d.id for r in mine for d in r.dsts) == list(range(100)) and {r.out_deg for r in mine} == {100}
    # a node without out-edges leads back to the target
    assert {(r.out_deg, len(r.dsts), r.dsts[0].kind) for (kind, _, _), r in split.items() if kind == 1} == {(1, 1, -1)}


def test_no_join_of_edges_with_nodes(spark):
    graph = R.bipartite_edges(_edges(spark, [(u, u % 7) for u in range(300)]))
    nodes = R.node_table(graph, 16).cache()
    plan = R.adjacency_blocks(graph, nodes, 16, R.heavy_nodes(nodes, 16))._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_salted_nodes_give_to_a_neighbour_from_one_bucket(spark, monkeypatch):
    """Many nodes with the same neighbours: all they give to one neighbour lies in one bucket, so a turn moves it once."""
    monkeypatch.setattr(R, "EDGES_PER_PLACE", 2)
    seen, write = [], R._write_bucketed

    def spy(blocks, table, parts, path):
        write(blocks, table, parts, path)
        seen.append(blocks.sparkSession.read.parquet(path).select(
            "src_kind", "place", F.explode("dsts").alias("d"), F.expr(f"pmod(hash(place), {parts})").alias("bucket")).cache())
        seen[-1].count()

    monkeypatch.setattr(R, "_write_bucketed", spy)
    pairs = [(u, i) for u in range(1, 200) for i in range(1000, 1012) if (u + i) % 5]
    for kw in ({}, {"broadcast_rows": 0}, {"broadcast_rows": 0, "block_size": 16}):
        seen.clear()
        many = R.walks(R.bipartite_edges(_edges(spark, pairs)), [1, 2, 3], max_iter=6, tol=0.0, partitions=3, **kw)
        for t in (1, 2, 3):
            _, want = _walk_by_hand(pairs, t, tol=0.0, max_iter=6)
            assert {(r.kind, r.id): r.score for r in many.of(t).scores.collect()} == pytest.approx(want, abs=1e-12)
        for blocks in seen:
            per = blocks.where(F.col("src_kind") == R.ITEM).groupBy("d.kind", "d.id").agg(F.count_distinct("bucket").alias("n"))
            assert per.count() == 199 and per.agg(F.max("n")).first()[0] == 1
            assert blocks.select("bucket").distinct().count() > 1
    assert not [t for t in spark.catalog.listTables() if "rank" in t.name]
