import itertools
import os
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartograph import sinks as SK
from cartograph.operators import cooccur as CO
from cartograph.session import materialize, tidy_session


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "user_id long, item_id long")


def _brute(pairs):
    baskets = {}
    for u, i in set(pairs):
        baskets.setdefault(u, set()).add(i)
    out = {}
    for items in baskets.values():
        for a, b in itertools.combinations(sorted(items), 2):
            out[(a, b)] = out.get((a, b), 0) + 1
    return out


def test_basic_pairs(spark):
    e = _edges(spark, [(1, 10), (1, 20), (1, 30), (2, 10), (2, 20)])
    got = {(r.item_a, r.item_b): r.n_users for r in CO.item_cooccurrence(e).collect()}
    assert got == {(10, 20): 2, (10, 30): 1, (20, 30): 1}


def test_deep_only_and_dedup(spark):
    from conftest import log_df
    log = log_df(spark, [(1, 10, 1, "cart", 1), (1, 10, 1, "buy", 2), (1, 20, 1, "pv", 3), (2, 20, 1, "fav", 4)])
    edges = CO.interaction_edges(log)
    assert sorted(map(tuple, edges.collect())) == [(1, 10), (2, 20)]
    idx = {r.item_id: r.user_ids for r in CO.inverted_index(edges).collect()}
    assert idx == {10: [1], 20: [2]}
    assert CO.item_cooccurrence(edges).count() == 0


def test_top_pairs_tie_order(spark):
    pairs = [(u, i) for u in range(3) for i in range(5)]  # every pair shared by 3 users
    top = CO.top_item_pairs(CO.item_cooccurrence(_edges(spark, pairs)), limit=4).collect()
    assert [(r.item_a, r.item_b, r.n_users) for r in top] == [(0, 1, 3), (0, 2, 3), (0, 3, 3), (0, 4, 3)]


def test_hot_user_split_matches_brute_force(spark):
    rng = random.Random(7)
    pairs = [(0, i) for i in range(60)]  # one hot basket of 60 items
    pairs += [(u, rng.randrange(80)) for u in range(1, 30) for _ in range(4)]
    e = _edges(spark, sorted(set(pairs)))
    for block in (4, 16, 1000):
        got = {(r.item_a, r.item_b): r.n_users for r in CO.item_cooccurrence(e, block_size=block).collect()}
        assert got == _brute(pairs), block


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 12)), max_size=40), st.integers(1, 5))
def test_pairs_property(spark, pairs, block):
    e = _edges(spark, sorted(set(pairs)))
    got = {(r.item_a, r.item_b): r.n_users for r in CO.item_cooccurrence(e, block_size=block).collect()}
    assert got == _brute(pairs)


def test_one_list_per_key_whatever_the_ids(spark):
    e = _edges(spark, [(1, 4174985), (1, 4263844), (1, 100), ((1 << 20) + 5, 100), ((1 << 40) + 7, 100)])
    assert {r.item_id: (r.block, r.user_ids) for r in CO.inverted_index(e).collect()} == {
        100: (0, [1, (1 << 20) + 5, (1 << 40) + 7]), 4174985: (0, [1]), 4263844: (0, [1])}
    assert {r.user_id: r.item_ids for r in CO.user_baskets(e).collect()}[1] == [100, 4174985, 4263844]


def test_heavy_lists_split_and_rejoin(spark):
    pairs = [(u * 7, 1) for u in range(50)] + [(u, 2) for u in range(4)]
    rows = CO.inverted_index(_edges(spark, pairs), max_list=4).collect()
    assert [(r.block, r.user_ids) for r in rows if r.item_id == 2] == [(0, [0, 1, 2, 3])]
    heavy = [r for r in rows if r.item_id == 1]
    assert len(heavy) > 1 and all(r.user_ids == sorted(r.user_ids) for r in heavy)
    assert sorted(u for r in heavy for u in r.user_ids) == [u * 7 for u in range(50)]


def test_pruned_top_pairs_exact(spark):
    rng = random.Random(11)
    pairs = [(u, i) for u in range(40) for i in range(10) if rng.random() < 0.8]   # popular items
    pairs += [(u, 1000 + 30 * u + j) for u in range(40) for j in range(30)]        # long tail
    e = _edges(spark, sorted(set(pairs)))
    full = CO.item_cooccurrence(e)
    for limit in (1, 2, 5, 50):
        want = [tuple(r) for r in CO.top_item_pairs(full, limit).collect()]
        got = [tuple(r) for r in CO.top_item_pairs_pruned(e, limit).collect()]
        assert got == want, limit
    brute = sorted(_brute(pairs).items(), key=lambda kv: (-kv[1], kv[0]))[:2]
    assert [tuple(r) for r in CO.top_item_pairs_pruned(e, 2).collect()] == [(a, b, n) for (a, b), n in brute]


@pytest.mark.parametrize("max_list", [1, 3, 64, 500])
def test_split_lists_are_ordered_segments(spark, max_list):
    """Segments of a heavy key, joined in order, are its sorted list; none is much above the bound."""
    rng = random.Random(max_list)
    users = {1: list(range(10_000, 13_000)), 2: [rng.randrange(1 << 60) - (1 << 59) for _ in range(2500)], 3: [5], 4: [7, 3, 9]}
    e = spark.createDataFrame([(u, i) for i, us in users.items() for u in us], "user_id long, item_id long").distinct().repartition(5)
    got = {}
    for r in CO.inverted_index(e, max_list=max_list).collect():
        got.setdefault(r.item_id, []).append((r.block, r.user_ids))
    for i, us in users.items():
        parts = [p for _, p in sorted(got[i])]
        assert [u for p in parts for u in p] == sorted(set(us)) and all(parts)
        if len(us) > 100:
            assert 0.9 * len(us) / max_list <= len(parts) <= -(-len(us) // max_list)
            assert max(map(len, parts)) <= max(2 * max_list, 2)
        elif len(us) <= max_list:
            assert [b for b, _ in got[i]] == [0]


def test_all_pairs_in_one_order(spark, tmp_out):
    """Files in name order hold the total order, cut inside the many equal counts; the index names their first keys."""
    import glob
    rng = random.Random(3)
    rows = [(a, b, 1 if rng.random() < 0.9 else rng.randrange(2, 50)) for a in range(60) for b in range(a + 1, 200)]
    rng.shuffle(rows)
    pairs = spark.createDataFrame(rows, "item_a long, item_b long, n_users long").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = {r.file: r for r in SK.write_cooccurrence_ordered(pairs, f"{tmp_out}/pairs").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = [f"{a},{b}\t{n}" for a, b, n in sorted(rows, key=lambda r: (-r[2], r[0], r[1]))]
    got = []
    for path in sorted(glob.glob(f"{tmp_out}/pairs/part-*")):
        lines = open(path).read().splitlines()
        r = index[os.path.basename(path)]
        assert (r.lines_before, r.n_lines) == (len(got), len(lines))
        assert lines[0] == f"{r.first_item_a},{r.first_item_b}\t{r.first_n_users}"
        got += lines
    assert got == want and len(index) > 1


def test_ordered_lines_are_numbered_in_place(spark, tmp_out):
    """Every line of every stretch of the files gets its place, and no line is shuffled for it."""
    rng = random.Random(4)
    rows = [(a, b, rng.randrange(1, 4)) for a in range(40) for b in range(a + 1, 120)]
    pairs = spark.createDataFrame(rows, "item_a long, item_b long, n_users long").repartition(6)
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "1000",
            "spark.sql.files.openCostInBytes": "0"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        index = SK.write_cooccurrence_ordered(pairs, f"{tmp_out}/pairs")
        lines = SK.read_ordered_lines(spark, f"{tmp_out}/pairs", index)
        got = [tuple(r) for r in lines.orderBy("line").collect()]
        assert lines.rdd.getNumPartitions() > 20 > index.count() > 1
        plan = lines._jdf.queryExecution().sparkPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    want = [f"{a},{b}\t{n}" for a, b, n in sorted(rows, key=lambda r: (-r[2], r[0], r[1]))]
    assert got == list(enumerate(want))
    assert "Window" not in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_")}


def test_ordering_moves_few_bytes_a_pair(spark, tmp_out):
    """Pairs get into order as packed stretches: a row of 36 bytes took 7 or more of them compressed."""
    n = 300_000
    pairs = spark.range(n).select((F.col("id") * 7919 % n).alias("i")).select(
        (F.col("i") % 600).alias("item_a"), (600 + F.col("i") / 600 * 13).cast("long").alias("item_b"),
        F.when(F.col("i") % 11 == 0, 2).otherwise(1).cast("long").alias("n_users"))
    pairs.write.parquet(f"{tmp_out}/table")
    before = _shuffle_files(spark)
    SK.write_cooccurrence_ordered(spark.read.parquet(f"{tmp_out}/table"), f"{tmp_out}/pairs")
    moved = sum(size for name, size in _shuffle_files(spark).items() if name not in before)
    assert moved < 3 * n


@pytest.mark.parametrize("span", [40, 1 << 33, 1 << 62])
def test_packed_pairs_in_order(spark, span):
    """Small and wide ids, repeated pairs, stretches of one pair and partitions within equal counts."""
    rng = random.Random(span)
    rows = [(rng.randrange(-span, span), rng.randrange(-span, span), rng.randrange(1, 4)) for _ in range(3000)]
    rows += [(-(1 << 63), (1 << 63) - 1, 1), ((1 << 63) - 1, -(1 << 63), 1)] * (span > 1 << 40)
    pairs = spark.createDataFrame(rows, "item_a long, item_b long, n_users long").repartition(5)
    want = sorted(rows, key=lambda r: (-r[2], r[0], r[1]))
    for kw in ({}, {"pairs_per_run": 170, "pairs_per_row": 7}, {"pairs_per_run": 900, "pairs_per_row": 1}):
        out = CO.ordered_pairs(pairs, **kw)
        parts = out.rdd.glom().map(lambda p: [tuple(r) for r in p]).collect()
        assert [r for p in parts for r in p] == want
        if kw:
            assert max(map(len, parts)) < 3 * kw["pairs_per_run"]
    assert CO.ordered_pairs(pairs.limit(0)).collect() == []
    with pytest.raises(Exception, match="has a null"):
        CO.ordered_pairs(spark.createDataFrame([(1, None, 1)], pairs.schema)).collect()


def test_ordered_query(spark, tmp_out):
    """The whole query over small tables: every line in its place, in files of the order."""
    from cartograph.plans.catalog import q_write_cooccurrence_ordered
    rng = random.Random(6)
    spark.createDataFrame([(o, o % 37) for o in range(300)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_out}/orders.parquet")
    items = [(o, rng.randrange(60), rng.choice("ANR")) for o in range(300) for _ in range(4)]
    (spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_returnflag string")
     .withColumn("l_shipdate", F.lit("1995-03-01").cast("timestamp")).write.parquet(f"{tmp_out}/lineitem.parquet"))
    got = [tuple(r) for r in q_write_cooccurrence_ordered(spark, tmp_out).orderBy("line").collect()]
    counts = _brute({(o % 37, i) for o, i, _ in items})
    want = [f"{a},{b}\t{n}" for (a, b), n in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))]
    assert got == list(enumerate(want))


def test_tidy_session_frees_shuffles(spark):
    """Shuffle files of a write in a tidy session go with it; the caller's settings stay."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, own, before = spark.conf.get(setting), tidy_session(spark), set(_shuffle_files(spark))
    kept = materialize(spark.range(1000).repartition(3), "shuffled")
    assert materialize(own.range(1000).repartition(3), "shuffled").count() == kept.count() == 1000
    for _ in range(50):
        left = {name.split("_")[1] for name in _shuffle_files(spark) if name not in before}
        if len(left) <= 1:
            break
        time.sleep(0.1)
    assert len(left) <= 1 and spark.conf.get(setting) == was


@pytest.mark.parametrize("far", [0, 1 << 40])
@pytest.mark.parametrize("kw", [{}, {"pairs_per_task": 7, "repeats": 1 << 30}, {"repeats": 0}, {"block_size": 4, "pairs_per_task": 50}])
def test_pairs_counted_by_any_route(spark, far, kw):
    """Items cut by salts, baskets in blocks, counts before the shuffle, ids too far apart for offsets, null and repeated keys."""
    rng = random.Random(5)
    pairs = sorted({(u, rng.choice([-3, 1, 2, rng.randrange(40)])) for u in range(30) for _ in range(12)})
    pairs = [(u, i + far * (i > 20)) for u, i in pairs]
    e = _edges(spark, pairs)
    nulls = spark.createDataFrame([(None, 1), (None, 2), (1, None), (2, None)], "user_id long, item_id long")
    got = [tuple(r) for r in CO.item_cooccurrence(e.unionByName(nulls), **kw).collect()]
    assert len(got) == len(set(got)) and {(a, b): n for a, b, n in got} == _brute(pairs)
    twice = e.unionByName(e.where("item_id = 1"))
    n1 = {(a, b): n for a, b, n in CO.item_cooccurrence(twice, **kw).collect()}
    assert n1 == {k: n * (2 if 1 in k else 1) for k, n in _brute(pairs).items()}


def test_counting_moves_lists_not_pairs(spark):
    e = _edges(spark, [(u, (u * 37 + j * j * 11) % 5000) for u in range(100) for j in range(20)]).distinct()
    plan = CO.item_cooccurrence(e, pairs_per_task=5000)._jdf.queryExecution().executedPlan().toString()
    # the only shuffle is that of an item's lists; the opened pairs are counted where they are
    assert plan.count("Exchange ") == 1 and "Exchange hashpartitioning(item_a" in plan and "Join" not in plan, plan
