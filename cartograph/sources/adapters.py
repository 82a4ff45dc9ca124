"""Behaviour logs derived from tabular inputs.

The driver tables hold no behaviour log, so these adapters derive one with
the same definitions the SQL oracle uses:

* events adapter: ``user_id``, item from ``props.k``, category ``item % 10``,
  behaviour from ``event_type``, epoch seconds, split by ``event_id % 4``;
* lineitem adapter: customer x part from ``orders`` joined to ``lineitem``;
* text adapter: the events log rendered as text lines, some of them damaged
  so that every parser rule is exercised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values of the adapters (shared with the SQL oracle)
# ---------------------------------------------------------------------------
EVENT_BEHAVIOR = {"view": "pv", "click": "fav", "signup": "cart", "purchase": "buy",
                  "error": "error"}
RETURNFLAG_BEHAVIOR = {"A": "fav", "N": "buy", "R": "cart"}
HEADER_LINE = "user_id,item_id,category_id,behavior_type,timestamp"
# event_id % 20 -> damage applied to the text line
DAMAGE_DROP_LAST, DAMAGE_BAD_CATEGORY, DAMAGE_DECIMAL_USER, DAMAGE_PADDED_UPPER = 0, 1, 2, 3
DAMAGE_EXTRA_FIELD, DAMAGE_CATEGORY_OVERFLOW, DAMAGE_HEADER, DAMAGE_EMPTY = 4, 5, 6, 7
# ---------------------------------------------------------------------------


def _epoch_seconds(df: DataFrame, name: str) -> Column:
    """Floored epoch seconds of a timestamp column, independent of session time zone."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    return F.unix_seconds(F.col(name))


def _mapped(col: str, mapping: dict[str, str], default: Column) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == k, v) if expr is None else expr.when(F.col(col) == k, v))
    return expr.otherwise(default)


def events_behavior_log(spark: SparkSession, sf_dir: str, with_split: bool = True) -> DataFrame:
    """Typed behaviour log from ``events`` (all five log columns + ``split``)."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    item = F.get_json_object("props", "$.k").cast("bigint")
    out = ev.select(
        F.col("event_id"),
        F.col("user_id"),
        item.alias("item_id"),
        (item % 10).cast("int").alias("category_id"),
        _mapped("event_type", EVENT_BEHAVIOR, F.col("event_type")).alias("behavior_type"),
        _epoch_seconds(ev, "ts").alias("ts"),
        F.when(F.col("event_id") % 4 != 3, "train").otherwise("test").alias("split"),
    )
    return out if with_split else out.drop("split")


def lineitem_behavior_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bench-sized log: customers x parts from ``orders`` join ``lineitem``."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    li = li.select("l_orderkey", "l_partkey", "l_returnflag",
                   _epoch_seconds(li, "l_shipdate").alias("ts"))
    j = li.join(orders, li.l_orderkey == orders.o_orderkey)
    return j.select(
        F.col("l_orderkey").alias("event_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.col("l_partkey") % 100).cast("int").alias("category_id"),
        _mapped("l_returnflag", RETURNFLAG_BEHAVIOR, F.lit("unknown")).alias("behavior_type"),
        F.col("ts"),
        F.when(F.col("l_orderkey") % 4 != 3, "train").otherwise("test").alias("split"),
    )


def log_lines(log: DataFrame) -> DataFrame:
    """Render a typed log as ``u,i,c,b,t`` text lines (``value``), keeping ``event_id``/``split``."""
    keep = [c for c in ("event_id", "split") if c in log.columns]
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in
                              ("user_id", "item_id", "category_id", "behavior_type", "ts")])
    return log.select(*keep, line.alias("value"))


def damaged_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events log as text with ``event_id % 20`` selecting one kind of damage."""
    log = events_behavior_log(spark, sf_dir)
    s = {c: F.col(c).cast("string") for c in ("user_id", "item_id", "category_id", "behavior_type", "ts")}
    d = F.col("event_id") % 20

    def line(*fields):
        return F.concat_ws(",", *fields)

    value = (
        F.when(d == DAMAGE_DROP_LAST, line(s["user_id"], s["item_id"], s["category_id"], s["behavior_type"]))
        .when(d == DAMAGE_BAD_CATEGORY, line(s["user_id"], s["item_id"], F.lit("x"), s["behavior_type"], s["ts"]))
        .when(d == DAMAGE_DECIMAL_USER, line(F.lit("1.5"), s["item_id"], s["category_id"], s["behavior_type"], s["ts"]))
        .when(d == DAMAGE_PADDED_UPPER, line(s["user_id"], s["item_id"], s["category_id"],
                                             F.concat(F.lit(" "), F.upper(s["behavior_type"]), F.lit(" ")), s["ts"]))
        .when(d == DAMAGE_EXTRA_FIELD, line(s["user_id"], s["item_id"], s["category_id"], s["behavior_type"], s["ts"],
                                            F.lit("extra")))
        .when(d == DAMAGE_CATEGORY_OVERFLOW, line(s["user_id"], s["item_id"], F.lit("9999999999"),
                                                  s["behavior_type"], s["ts"]))
        .when(d == DAMAGE_HEADER, F.lit(HEADER_LINE))
        .when(d == DAMAGE_EMPTY, F.lit(""))
        .otherwise(line(s["user_id"], s["item_id"], s["category_id"], s["behavior_type"], s["ts"]))
    )
    return log.select("event_id", "split", value.alias("value"))
