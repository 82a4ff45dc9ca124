from conftest import lines_df

from cartograph.plans import jobs as J
from cartograph.sources import text as TX

TRAIN = ["user_id,item_id,category_id,behavior_type,timestamp",
         "1,10,100,buy,1000", "1,20,100,cart,1100", "2,10,100,fav,1200", "2,30,100,pv,1300",
         "3,20,100,cart,1400", "3,10,101,pv,1500", "4,30,100,buy,1600", "bad,line", ""]
TEST = ["1,30,100,fav,2000", "5,20,100,buy,2100", "2,20,x,cart,2200"]


def _write(spark, out, name, lines):
    path = f"{out}/{name}"
    lines_df(spark, lines).coalesce(1).write.text(path)
    return path


def test_all_jobs_end_to_end(spark, tmp_out):
    train, test = _write(spark, tmp_out, "train", TRAIN), _write(spark, tmp_out, "test", TEST)

    f = J.run_features(spark, train, test, f"{tmp_out}/t1")
    feats = {r.user_id: (r.f1, r.f2, r.f3) for r in f.result.collect()}
    assert sorted(feats) == [1, 2, 3, 4, 5]
    assert all(0.0 <= v <= 1.0 for row in feats.values() for v in row)
    clean = spark.read.text(f.paths["clean_log"]).collect()
    assert len(clean) == 9 and clean[0].value.count(",") == 4
    text = [r.value for r in spark.read.text(f.paths["features"]).collect()]
    assert all(len(x.split(",")[1].split(".")[1]) == 4 for x in text)

    c = J.run_cooccurrence(spark, train, test, f"{tmp_out}/t2")
    lines = sorted(r.value for r in c.result.collect())
    # deep baskets: 1 {10,20,30}, 2 {10} (the category-x row is rejected), 3 {20}, 4 {30}, 5 {20}
    assert lines == ["10,20\t1", "10,30\t1", "20,30\t1"]
    idx = sorted(r.value for r in spark.read.text(c.paths["index"]).collect())
    assert idx == ["10\t1,2", "20\t1,3,5", "30\t1,4"]

    import pytest
    with pytest.raises(Exception, match="bad user id"):
        J.run_clustering(spark, f.paths["features"], f"{tmp_out}/t3-strict", train, k=2)
    ids = _write(spark, tmp_out, "train-ids", [x for x in TRAIN if x != "bad,line"] + ["4,1,1,share,1"])
    k = J.run_clustering(spark, f.paths["features"], f"{tmp_out}/t3", ids, k=2)
    labels = {tuple(map(int, r.value.split(","))) for r in k.result.collect()}
    assert {u for u, _ in labels} == {1, 2, 3, 4}  # user 5 is not a training user
    centres = [r.value for r in spark.read.text(k.paths["centres"]).collect()]
    assert [x.split("\t")[0] for x in centres] == ["0", "1"]

    r = J.run_rank(spark, train, test, f"{tmp_out}/t4", target=3)
    line = r.result.first().value
    target, entries = line.split("\t")
    # user 3's only deep item is 20; the lenient parse keeps user 2's category-x cart of 20
    assert target == "3" and [x.split(":")[0] for x in entries.split(",")] == ["10", "30"]

    stats = [{r.metric: r.value for r in job.stats.collect()} for job in (f, c, k, r)]
    assert stats[0]["n_train_rows"] == 7 and stats[0]["n_test_rows"] == 2 and stats[0]["max_ts"] == 2100
    assert stats[1] == {"n_lines": 13, "n_deep_rows": 7, "n_edges": 7, "n_items": 3, "n_users": 5, "n_pairs": 3}
    assert stats[2]["n_train_users"] == 4 == stats[2]["n_clustered_users"]
    assert stats[2]["n_cluster_0"] + stats[2]["n_cluster_1"] == 4
    assert stats[3]["target_in_graph"] == 1 and stats[3]["n_edges"] == 16 and stats[3]["low_score"] == 0


def test_sorted_sinks_keep_line_order(spark, tmp_out):
    from cartograph import sinks
    rows = [(i % 7, 100 + i, i % 5) for i in range(60)]
    sinks.write_cooccurrence(spark.createDataFrame(rows, "item_a long, item_b long, n_users long").repartition(6), f"{tmp_out}/pairs")
    want = sorted(rows, key=lambda r: (-r[2], r[0], r[1]))
    assert [r.value for r in spark.read.text(f"{tmp_out}/pairs").collect()] == ["%d,%d\t%d" % r for r in want]
    centres = spark.createDataFrame([(i, 0.1 * i, 0.0, 1.0) for i in range(5)], "cluster_id int, f1 double, f2 double, f3 double")
    sinks.write_centres(centres.repartition(4), f"{tmp_out}/centres")
    assert [r.value.split("\t")[0] for r in spark.read.text(f"{tmp_out}/centres").collect()] == list("01234")


def test_writers_refuse_existing_output(spark, tmp_out):
    import pytest

    from cartograph import sinks
    df = spark.createDataFrame([(1, 2, 3)], "item_a long, item_b long, n_users long")
    sinks.write_cooccurrence(df, f"{tmp_out}/p")
    with pytest.raises(Exception):
        sinks.write_cooccurrence(df, f"{tmp_out}/p")
    assert spark.read.text(f"{tmp_out}/p").first().value == "1,2\t3"


def test_command_line(spark, tmp_out):
    from cartograph.__main__ import main
    train = _write(spark, tmp_out, "cli-train", TRAIN)
    assert main(["cooccurrence", train, f"{tmp_out}/cli-co"]) == 0
    # train only: user 1 holds {10, 20} (its fav of 30 is in the test split)
    assert [r.value for r in spark.read.text(f"{tmp_out}/cli-co/item_co_occurrence.txt").collect()] == ["10,20\t1"]


def test_one_scan_for_log_and_rejects(spark, tmp_out):
    """The log, the rejected lines and the counts of a job come from one read of the text."""
    train, test = _write(spark, tmp_out, "train", TRAIN), _write(spark, tmp_out, "test", TEST)
    job = J.run_features(spark, train, test, f"{tmp_out}/t1")
    assert sorted(tuple(r) for r in job.rejected.collect()) == [("2,20,x,cart,2200", "number"), ("bad,line", "arity")]
    stats = {r.metric: r.value for r in job.stats.collect()}
    assert stats["n_lines"] == len(TRAIN) + len(TEST) and stats["n_rejected"] == 2
    routes = TX.write_routes(TX.read_lines(spark, train))
    for df in (routes.log, routes.rejected, routes.header, routes.blank):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "PartitionFilters: [isnotnull(route" in plan and "FileScan text" not in plan
    assert routes.counts == {"n_lines": 10, "n_header": 1, "n_blank": 1, "n_data": 8, "n_rejected_arity": 1, "n_rejected_number": 0, "n_parsed": 7}
    assert [df.count() for df in (routes.log, routes.rejected, routes.header, routes.blank)] == [7, 1, 1, 1]
    # before it is written, the whole of it is one scan of the text
    plan = TX.route_lines(TX.read_lines(spark, train))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1


def test_stats_need_no_scan_of_the_text(spark, tmp_out):
    """Jobs read each text file once: all counts are taken while they write."""
    train, test = _write(spark, tmp_out, "train", TRAIN), _write(spark, tmp_out, "test", TEST)
    reads = []
    plain = TX.read_lines

    def counted(s, paths):
        reads.extend([paths] if isinstance(paths, str) else paths)
        return plain(s, paths)

    TX.read_lines = counted
    try:
        J.run_features(spark, train, test, f"{tmp_out}/t1").stats.collect()
        assert sorted(p for p in reads if p in (train, test)) == sorted([train, test])
        reads.clear()
        J.run_cooccurrence(spark, train, test, f"{tmp_out}/t2").stats.collect()
        assert sorted(reads) == sorted([train, test])
    finally:
        TX.read_lines = plain


def test_jobs_on_empty_files(spark, tmp_out):
    empty = _write(spark, tmp_out, "empty", [""])
    stats = {r.metric: r.value for r in J.run_features(spark, empty, empty, f"{tmp_out}/t1").stats.collect()}
    assert stats["n_lines"] == 2 and stats["n_users"] == 0 and "max_ts" not in stats
    stats = {r.metric: r.value for r in J.run_cooccurrence(spark, empty, None, f"{tmp_out}/t2").stats.collect()}
    assert stats["n_lines"] == 2 and {stats[k] for k in ("n_deep_rows", "n_edges", "n_items", "n_users", "n_pairs")} == {0}
