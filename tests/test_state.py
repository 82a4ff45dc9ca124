import random

import pytest
from conftest import lines_df

from cartograph.operators import features as FT
from cartograph.operators.clean import clean_behavior_log
from cartograph.plans import state as ST
from cartograph.session import materialize
from cartograph.sources import text as TX


def _day(spark, out, name, seed, n=60):
    rng = random.Random(seed)
    lines = ["user_id,item_id,category_id,behavior_type,timestamp", "bad,line", ""]
    lines += [f"{rng.randrange(20)},{rng.randrange(9)},1,{rng.choice(['pv', 'buy', 'cart', 'fav', 'share'])},{rng.randrange(10 ** 6)}" for _ in range(n)]
    path = f"{out}/{name}"
    lines_df(spark, lines).repartition(2).write.mode("overwrite").text(path)
    return path


def _full(spark, paths):
    log = clean_behavior_log(TX.read_behavior_log(spark, paths))
    return sorted(map(tuple, FT.normalized_user_features(log).collect()))


def _rows(spark, state):
    return sorted(map(tuple, ST.features(spark, state).collect()))


@pytest.fixture
def reads(monkeypatch):
    """Paths given to the text reader."""
    seen, plain = [], TX.read_lines
    monkeypatch.setattr(TX, "read_lines", lambda s, paths: (seen.extend([paths] if isinstance(paths, str) else paths), plain(s, paths))[1])
    return seen


def test_refresh_reads_new_splits_only(spark, tmp_out, reads):
    state, days = f"{tmp_out}/state", {f"day{i}": _day(spark, tmp_out, f"day{i}", i) for i in (1, 2)}
    first = ST.refresh(spark, state, days)
    assert first.read == ["day1", "day2"] and sorted(reads) == sorted(days.values()) and len(first.files) == 4
    assert _rows(spark, state) == _full(spark, list(days.values()))
    reads.clear()
    days["day3"] = _day(spark, tmp_out, "day3", 3)
    second = ST.refresh(spark, state, days)
    assert second.read == ["day3"] and second.unchanged == ["day1", "day2"] and reads == [days["day3"]]
    assert len(second.files) == 2 and all("day3" in f for f in second.files)
    assert _rows(spark, state) == _full(spark, list(days.values()))
    reads.clear()
    third = ST.refresh(spark, state, days)
    assert reads == [] and third.read == third.files == [] and len(third.unchanged) == 3
    # the features themselves read the partials, never the text
    assert "text" not in ST.merged(spark, state)._jdf.queryExecution().executedPlan().toString().lower()


def test_changed_and_dropped_splits(spark, tmp_out, reads):
    state, days = f"{tmp_out}/state", {f"day{i}": _day(spark, tmp_out, f"day{i}", i) for i in (1, 2)}
    ST.refresh(spark, state, days)
    _day(spark, tmp_out, "day1", 9, n=80)
    reads.clear()
    again = ST.refresh(spark, state, days)
    assert again.read == ["day1"] and reads == [days["day1"]] and ST.current(spark, state)["day1"]["version"] == 2
    assert _rows(spark, state) == _full(spark, list(days.values()))
    gone = ST.refresh(spark, state, {"day2": days["day2"]})
    assert gone.dropped == ["day1"] and gone.read == [] and _rows(spark, state) == _full(spark, [days["day2"]])
    back = ST.refresh(spark, state, days)
    assert back.read == ["day1"] and ST.current(spark, state)["day1"]["version"] == 3
    rows = ST.lineage(spark, state).collect()
    assert len(rows) == 5 and {(r["split"], r["run"], r["dropped"]) for r in rows if r["run"] > 1} == {("day1", 2, False), ("day1", 3, True), ("day1", 4, False)}
    assert all(r["n_lines"] == r["n_records"] + 3 for r in rows if not r["dropped"] and r["n_lines"])


def test_a_refresh_that_died_changes_nothing(spark, tmp_out, monkeypatch):
    state, days = f"{tmp_out}/state", {"day1": _day(spark, tmp_out, "day1", 1)}
    ST.refresh(spark, state, days)
    was = _rows(spark, state)
    days |= {"day2": _day(spark, tmp_out, "day2", 2), "day3": _day(spark, tmp_out, "day3", 3)}
    plain = ST.clean_behavior_log
    calls = iter([plain])
    monkeypatch.setattr(ST, "clean_behavior_log", lambda log: next(calls)(log))  # the second split fails
    with pytest.raises(Exception):
        ST.refresh(spark, state, days)
    assert _rows(spark, state) == was
    monkeypatch.setattr(ST, "clean_behavior_log", plain)
    assert ST.refresh(spark, state, days).read == ["day2", "day3"]
    assert _rows(spark, state) == _full(spark, list(days.values()))


def test_empty_state_and_bad_names(spark, tmp_out):
    assert ST.features(spark, f"{tmp_out}/none").collect() == []
    with pytest.raises(ValueError):
        ST.refresh(spark, f"{tmp_out}/none", {"a/b": tmp_out})
    with pytest.raises(FileNotFoundError):
        ST.refresh(spark, f"{tmp_out}/none", {"a": f"{tmp_out}/missing"})
    assert materialize(ST.lineage(spark, f"{tmp_out}/none"), "x").count() == 0
