from conftest import lines_df

from cartograph.sources import text as TX

# (line, strict result, lenient result); result None = dropped, else behaviour
CASES = [
    ("user_id,item_id,category_id,behavior_type,timestamp", None, None),
    ("", None, None),
    ("   \t ", None, None),
    ("1,10,100,PV,1000", "pv", "pv"),
    (" 1 , 10 , 100 , Buy , 1000 ", "buy", "buy"),
    ("1,10,100,buy\t,1000", "buy", "buy"),
    ("+1,10,100,fav,1000", "fav", "fav"),
    ("1,10,100,cart,1000,extra", "cart", "cart"),
    ("1,10,100,cart", None, None),
    ("1,10,100,cart,", None, None),
    ("1,10,x,cart,1000", None, "cart"),
    ("1,10,9999999999,cart,1000", None, "cart"),
    ("1.5,10,100,cart,1000", None, None),
    ("1e3,10,100,cart,1000", None, None),
    ("0x1F,10,100,cart,1000", None, None),
    ("99999999999999999999,10,100,cart,1000", None, None),
    ('1,10,100,"buy",1000', '"buy"', '"buy"'),
    ("1,10,100,share,1000", "share", "share"),
]


def _run(spark, require_category):
    df = lines_df(spark, [c[0] for c in CASES])
    got = TX.parse_behavior_lines(df, require_category=require_category).collect()
    return sorted(r.behavior_type for r in got)


def test_strict_parse(spark):
    expected = sorted(c[1] for c in CASES if c[1] is not None)
    assert _run(spark, True) == expected


def test_lenient_parse(spark):
    expected = sorted(c[2] for c in CASES if c[2] is not None)
    assert _run(spark, False) == expected


def test_header_on_any_line_and_typed_values(spark):
    df = lines_df(spark, ["5,6,7,pv,8", "user_id,anything", "user_idx,1,2,pv,3"])
    rows = TX.parse_behavior_lines(df).collect()
    assert [(r.user_id, r.item_id, r.category_id, r.behavior_type, r.ts) for r in rows] == [(5, 6, 7, "pv", 8)]


def test_rejected_lines_reasons(spark):
    df = lines_df(spark, ["1,10,100,cart", "1,10,x,cart,1000", "1,10,100,cart,1000", "", "user_id"])
    got = {(r.value, r.reason) for r in TX.rejected_lines(df).collect()}
    assert got == {("1,10,100,cart", "arity"), ("1,10,x,cart,1000", "number")}
    assert TX.rejected_lines(df, require_category=False).count() == 1


def test_user_ids_strict_and_lenient(spark):
    import pytest
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError

    good = lines_df(spark, ["user_id,x", "7,1,2,share,3", "8,garbage", "7,1,2,pv,3"])
    assert sorted(r.user_id for r in TX.parse_user_ids(good).collect()) == [7, 8]
    bad = lines_df(spark, ["1.5,1,2,pv,3", "9,1,2,pv,3"])
    with pytest.raises((PySparkException, Py4JJavaError, Exception)):
        TX.parse_user_ids(bad, strict=True).collect()
    assert [r.user_id for r in TX.parse_user_ids(bad, strict=False).collect()] == [9]


def test_user_features_parse(spark):
    df = lines_df(spark, ["1,0.5,0.25,1.0", "2,0.1,x,0.3", "3,0.1,0.2", "", "4,1,2,3,extra"])
    rows = sorted(tuple(r) for r in TX.parse_user_features(df).collect())
    assert rows == [(1, 0.5, 0.25, 1.0), (4, 1.0, 2.0, 3.0)]


def test_read_lines_keeps_duplicate_paths(spark, tmp_out):
    p = f"{tmp_out}/log"
    lines_df(spark, ["1,10,100,pv,1000", "2,10,100,buy,1001"]).write.text(p)
    assert TX.read_lines(spark, [p, p]).count() == 4
    assert TX.read_behavior_log(spark, p).count() == 2


def test_line_stats(spark):
    df = lines_df(spark, [c[0] for c in CASES])
    st = TX.line_stats(df).first().asDict()
    n_parsed = sum(1 for c in CASES if c[1] is not None)
    assert st["n_lines"] == len(CASES) and st["n_header"] == 1 and st["n_blank"] == 2
    assert st["n_parsed"] == n_parsed
    assert st["n_data"] == st["n_parsed"] + st["n_rejected_arity"] + st["n_rejected_number"]
    assert st["n_rejected_arity"] == 1


def test_feature_numbers_follow_the_jvm(spark):
    from cartograph.sources import text as TX
    lines = ["1,inf,0.1,0.2", "2,NaN,0,0", "3,nan,0,0", "4,Infinity,1,1", "5,+Infinity,1,-Infinity", "6,INFINITY,1,1", "7, 1e3 ,\t2,3",
             "8,1,2", "9,1,2,x", "10,-inf,1,1", "11,1,2,3,inf"]
    got = {r.user_id for r in TX.parse_user_features(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert got == {2, 4, 5, 7, 11}


def test_partitioned_folder_reads_lines_only(spark, tmp_out):
    from cartograph.sources import text as TX
    spark.createDataFrame([("a", 1), ("b", 2)], "value string, dt int").write.partitionBy("dt").text(f"{tmp_out}/parts")
    spark.createDataFrame([("c",)], "value string").write.text(f"{tmp_out}/plain")
    df = TX.read_lines(spark, [f"{tmp_out}/parts", f"{tmp_out}/plain"])
    assert df.columns == ["value"] and sorted(r.value for r in df.collect()) == ["a", "b", "c"]


def test_scratch_refuses_one_machines_disk():
    import pytest

    from cartograph.session import fallback_root
    assert fallback_root("file:/tmp/w", "local[4]").startswith("file:/tmp/w/")
    assert fallback_root("hdfs://store/w", "yarn").startswith("hdfs://store/w/")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            fallback_root("file:/home/me/spark-warehouse", master)
