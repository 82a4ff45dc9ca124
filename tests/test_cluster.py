import math
import random

import pytest

from cartograph import sinks as SK
from cartograph.operators import cluster as KM


def _pts(spark, rows):
    return spark.createDataFrame(rows, "user_id long, f1 double, f2 double, f3 double")


def test_tie_goes_to_lower_id(spark):
    pts = _pts(spark, [(1, 0.5, 0.0, 0.0)])
    got = KM.assign_nearest(pts, [(1.0, 0.0, 0.0), (0.0, 0.0, 0.0)]).first().cluster_id
    assert got == 0


def test_duplicate_centres_keep_empty_cluster(spark):
    pts = _pts(spark, [(1, 0.0, 0.0, 0.0), (2, 1.0, 1.0, 1.0), (3, 0.9, 0.9, 0.9)])
    centres = [(0.0, 0.0, 0.0), (1.0, 1.0, 1.0), (1.0, 1.0, 1.0)]
    new = KM.update_centres(pts, centres)
    assert new[2] == (1.0, 1.0, 1.0) and new[1] == pytest.approx((0.95, 0.95, 0.95))
    sizes = {r.cluster_id: r.n_users for r in KM.cluster_sizes(KM.assign_nearest(pts, centres)).collect()}
    assert sizes == {0: 1, 1: 2, 2: 0}


def test_fewer_points_than_k(spark):
    with pytest.raises(ValueError):
        KM.kmeans(_pts(spark, [(1, 0.0, 0.0, 0.0), (2, 1.0, 1.0, 1.0)]), k=3)


def test_restrict_to_users(spark):
    pts = _pts(spark, [(1, 0.0, 0.0, 0.0), (2, 1.0, 1.0, 1.0)])
    users = spark.createDataFrame([(2,), (3,)], "user_id long")
    assert [r.user_id for r in KM.restrict_to_users(pts, users).collect()] == [2]


def test_one_iteration_centres_are_means(spark):
    pts = _pts(spark, [(1, 0.0, 0.0, 0.0), (2, 0.2, 0.0, 0.0), (3, 1.0, 1.0, 1.0), (4, 0.8, 1.0, 1.0)])
    res = KM.kmeans(pts, k=2, max_iter=1, init=[(0.0, 0.0, 0.0), (1.0, 1.0, 1.0)])
    assert res.iterations == 1
    assert res.centres[0] == pytest.approx((0.1, 0.0, 0.0)) and res.centres[1] == pytest.approx((0.9, 1.0, 1.0))
    assert {r.user_id: r.cluster_id for r in res.labels.collect()} == {1: 0, 2: 0, 3: 1, 4: 1}


def test_converges_and_cost_never_rises(spark):
    import random
    rng = random.Random(3)
    rows = [(i, rng.random(), rng.random(), rng.random()) for i in range(60)]
    pts = _pts(spark, rows)
    init = KM.init_centres(pts, 3)
    assert init == [tuple(r[1:]) for r in rows[:3]]

    def cost(centres):
        return sum(min(sum((a - b) ** 2 for a, b in zip(r[1:], c)) for c in centres) for r in rows)

    centres, last = init, cost(init)
    for _ in range(5):
        centres = KM.update_centres(pts, centres)
        c = cost(centres)
        assert c <= last + 1e-12
        last = c
    res = KM.kmeans(pts, k=3, max_iter=50)
    assert res.converged and res.shifts[-1] < 1e-4


def test_seeded_init_is_deterministic(spark):
    pts = _pts(spark, [(i, float(i), 0.0, 0.0) for i in range(10)])
    assert KM.init_centres(pts, 3, "seeded") == KM.init_centres(pts.repartition(3), 3, "seeded")


def test_labels_read_written_points(spark):
    pts = _pts(spark, [(i, float(i), 0.0, 0.0) for i in range(6)])
    res = KM.kmeans(pts, k=2, max_iter=3)
    plan = res.labels._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "Relation" in plan


def test_mean_on_the_rounding_edge_is_exact(spark):
    """Forty thousand features whose mean is exactly 0.92445 print half up, in any order and split."""
    values = [0.9244, 0.9245, 0.9243, 0.9246] * 10_000
    want = "0\t0.9245,0.9245,0.9245"
    for parts, step in ((1, 1), (4, 7), (8, 3), (13, 9)):
        order = [values[(i * step) % len(values)] for i in range(len(values))]
        pts = _pts(spark, [(i, v, v, v) for i, v in enumerate(order)]).repartition(parts)
        new = KM.update_centres(pts, [(0.5, 0.5, 0.5)])
        assert new == [(0.92445, 0.92445, 0.92445)]
        frame = KM.update_centres_frame(pts, [(0.5, 0.5, 0.5)])
        assert [r["value"] for r in SK.centre_lines(frame).collect()] == [want]


def test_sums_do_not_depend_on_order(spark):
    rng = random.Random(1)
    rows = [(i, rng.random(), rng.random() * 1e-9, rng.uniform(-1e8, 1e8)) for i in range(5000)]
    seen = set()
    for parts in (1, 3, 8):
        rng.shuffle(rows)
        pts = _pts(spark, rows).repartition(parts)
        seen.add(tuple(KM.update_centres(pts, [(0.0, 0.0, 0.0)])[0]))
    assert len(seen) == 1
    assert list(seen)[0] == pytest.approx([math.fsum(r[k] for r in rows) / 5000 for k in (1, 2, 3)], rel=1e-12)


def test_special_values_reach_the_centre(spark):
    inf, nan = math.inf, math.nan
    pts = _pts(spark, [(1, inf, nan, 1e12), (2, 0.5, 0.5, 0.5), (3, 1.0, -inf, 2.5e9)])
    got = KM.cluster_sums(pts, [(0.0, 0.0, 0.0)]).first()
    assert got["sum_f1"] == inf and math.isnan(got["sum_f2"]) and got["sum_f3"] == 1e12 + 2.5e9 + 0.5 and got["n"] == 3
