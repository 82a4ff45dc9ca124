"""Schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original programs' constants for equal results)
# ---------------------------------------------------------------------------
# Header lines are recognised by this prefix, on any line, case-sensitive.
HEADER_PREFIX = "user_id"
# Accepted behaviour types after trim + lower-case.
VALID_BEHAVIORS = ("pv", "cart", "fav", "buy")
# "Deep" interactions used for the item graph.
DEEP_BEHAVIORS = ("cart", "fav", "buy")
# Behaviour weights for the value score; anything else weighs 0.
BEHAVIOR_WEIGHTS = {"buy": 4, "cart": 3, "fav": 2, "pv": 1}
SECONDS_PER_DAY = 86400.0
# Min-max scaling of a constant column yields this value.
CONSTANT_SCALE_VALUE = 0.5
FEATURE_DECIMALS = 4
# k-means: clusters, iteration cap, centre-shift tolerance.
KMEANS_K = 3
KMEANS_MAX_ITER = 20
KMEANS_TOL = 1e-4
# Personal rank: continue probability, iteration cap, L-inf tolerance, top-k.
RANK_ALPHA = 0.85
RANK_MAX_ITER = 100
RANK_TOL = 1e-4
RANK_TOP_K = 10
RANK_DECIMALS = 3
# Co-occurrence report size.
TOP_PAIRS = 1000
# ---------------------------------------------------------------------------

BEHAVIOR_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("item_id", T.LongType(), False),
        T.StructField("category_id", T.IntegerType(), True),
        T.StructField("behavior_type", T.StringType(), False),
        T.StructField("ts", T.LongType(), False),
    ]
)

FEATURE_COLUMNS = ("f1", "f2", "f3")
