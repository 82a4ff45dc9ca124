from pyspark.sql import functions as F

from cartograph import functions as FN


def _one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(col.alias("y")).first().y


def test_java_trim_strips_control_chars(spark):
    assert _one(spark, FN.java_trim("x"), "\t\n Buy \r\x01") == "Buy"
    assert _one(spark, FN.java_trim("x"), "  a b  ") == "a b"


def test_parse_long_rules(spark):
    cases = {"+5": 5, "-7": -7, " 12 ": 12, "007": 7, "1.5": None, "1e3": None, "0x1F": None,
             "5L": None, "": None, "9223372036854775807": 9223372036854775807,
             "9223372036854775808": None}
    for text, want in cases.items():
        assert _one(spark, FN.parse_long("x"), text) == want, text
    assert _one(spark, FN.parse_int("x"), "9999999999") is None


def test_weights_and_scaling(spark):
    assert [_one(spark, FN.behavior_weight("x"), b) for b in ("buy", "cart", "fav", "pv", "share")] == [4, 3, 2, 1, 0]
    assert _one(spark, FN.behavior_weight("x", {"pv": 7}), "pv") == 7
    assert _one(spark, FN.min_max_scale("x", F.lit(3.0), F.lit(3.0)), 3.0, "double") == 0.5
    assert _one(spark, FN.min_max_scale("x", F.lit(2.0), F.lit(6.0)), 3.0, "double") == 0.25
    assert _one(spark, FN.day_difference(F.lit(172800), "x"), 0, "long") == 2.0


def test_fixed_point_text_is_half_up(spark):
    # the shortest decimal form is rounded half up, as fixed-point text on the JVM does
    assert _one(spark, FN.format_fixed("x", 4), 1.00005, "double") == "1.0001"
    assert _one(spark, FN.format_fixed("x", 4), 0.00015, "double") == "0.0002"
    assert _one(spark, FN.format_fixed("x", 3), 0.0956027, "double") == "0.096"
    assert _one(spark, F.round("x", 4), 1.00005, "double") == 1.0001


def test_distance_and_node_names(spark):
    d = FN.euclidean_distance([F.col("x"), F.lit(4.0)], [F.lit(0.0), F.lit(0.0)])
    assert _one(spark, d, 3.0, "double") == 5.0
    name = FN.node_name(F.lit(1), F.col("x"))
    assert _one(spark, name, 42, "long") == "I_42"
    kind, node_id = FN.node_kind_id(F.lit("U_77"))
    assert _one(spark, F.struct(kind, node_id), "", "string") == (0, 77)
