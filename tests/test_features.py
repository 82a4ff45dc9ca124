import pytest
from conftest import log_df

from cartograph.operators import clean as C
from cartograph.operators import features as FT


def _norm(spark, rows):
    return {r.user_id: (r.f1, r.f2, r.f3) for r in FT.normalized_user_features(log_df(spark, rows)).collect()}


def test_single_user_scales_to_half(spark):
    assert _norm(spark, [(1, 10, 1, "pv", 100), (1, 11, 1, "buy", 200)]) == {1: (0.5, 0.5, 0.5)}


def test_weights_and_activity(spark):
    rows = [(1, 10, 1, b, 100 + i) for i, b in enumerate(["buy", "cart", "fav", "pv"])]
    agg = FT.user_aggregate(log_df(spark, rows)).first()
    assert (agg.activity_count, agg.value_score, agg.max_ts) == (4, 10.0, 103)


def test_duplicates_count_twice(spark):
    rows = [(1, 10, 1, "pv", 100), (1, 10, 1, "pv", 100)]
    assert FT.user_aggregate(log_df(spark, rows)).first().activity_count == 2


def test_recency_from_global_max(spark):
    day = 86400
    rows = [(1, 10, 1, "pv", 0), (2, 10, 1, "pv", 2 * day), (3, 10, 1, "pv", 4 * day)]
    feats = {r.user_id: r.recency_days for r in FT.user_features(log_df(spark, rows)).collect()}
    assert feats == {1: 4.0, 2: 2.0, 3: 0.0}
    norm = _norm(spark, rows)
    assert norm[1][0] == 1.0 and norm[3][0] == 0.0 and norm[2][0] == 0.5


def test_split_merge_equals_whole(spark):
    train = log_df(spark, [(1, 10, 1, "pv", 5), (2, 11, 1, "buy", 9)])
    test = log_df(spark, [(1, 12, 1, "cart", 7), (3, 11, 1, "fav", 3)])
    merged = FT.merge_user_aggregates(FT.user_aggregate(train), FT.user_aggregate(test))
    whole = FT.user_aggregate(C.union_splits(train, test))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    assert {r.user_id: r.max_ts for r in merged.collect()}[1] == 7


def test_half_up_rounding(spark):
    # activity 0..8 over range 8: 1/8 = 0.125 -> 4 decimals exact; 3 users give thirds
    rows = [(u, 10, 1, "pv", 1) for u in range(3) for _ in range(u + 1)]
    norm = _norm(spark, rows)
    assert norm[1][1] == 0.5 and norm[0][1] == 0.0 and norm[2][1] == 1.0


def test_empty_log_gives_empty_features(spark):
    assert FT.normalized_user_features(log_df(spark, [])).count() == 0


def test_clean_filter(spark):
    rows = [(1, 1, 1, b, 1) for b in ["pv", "cart", "fav", "buy", "error", "share"]]
    assert C.clean_behavior_log(log_df(spark, rows)).count() == 4
    assert C.deep_interactions(log_df(spark, rows)).count() == 3


@pytest.mark.parametrize("by", [(), ("behavior_type",)])
def test_log_stats(spark, by):
    rows = [(1, 1, 1, "pv", 1), (1, 2, 1, "buy", 5), (2, 2, 1, "pv", 3)]
    st = C.log_stats(log_df(spark, rows), by=list(by)).collect()
    assert sum(r.n_rows for r in st) == 3


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 5), st.sampled_from(["pv", "cart", "fav", "buy"]),
                          st.integers(0, 10 ** 6)), min_size=1, max_size=30))
def test_scaled_features_property(spark, rows):
    log = log_df(spark, [(u, 1, 1, b, t) for u, b, t in rows])
    feats = FT.normalized_user_features(log, decimals=None).collect()
    for col in ("f1", "f2", "f3"):
        vals = [r[col] for r in feats]
        assert all(0.0 <= v <= 1.0 for v in vals)
        if len(set(vals)) == 1:
            assert vals[0] == 0.5
        else:
            assert min(vals) == 0.0 and max(vals) == 1.0
