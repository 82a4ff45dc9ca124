"""Behaviour-log and feature text files.

The log is comma separated text, ``user_id,item_id,category_id,
behavior_type,timestamp`` by position.  A line starting with ``user_id`` is a
header (on any line, not only the first) and blank lines are skipped.  Extra
fields are ignored; there is no CSV quoting, so files are read with
``read.text`` and split, never with the CSV reader.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartograph.functions.columns import java_trim, parse_double, parse_int, parse_long, split_field
from cartograph.schema import BEHAVIOR_SCHEMA, HEADER_PREFIX
from cartograph.session import observed, scratch_path

_LOG_ARITY = 5
_FEATURE_ARITY = 4


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Text lines of one or more files/dirs/globs as ``value STRING``.

    Several paths are read one by one and bag-unioned, so giving the same
    path twice doubles its lines (duplicates are kept, as a union of splits).
    """
    if isinstance(paths, str):
        paths = [paths]
    # only the line itself: a partitioned folder would add its partition columns
    frames = [spark.read.text(p).select("value") for p in paths]
    return reduce(DataFrame.union, frames)


def _data_lines(lines: DataFrame) -> DataFrame:
    """Drop header lines (prefix test) and blank lines."""
    v = F.col("value")
    return lines.where(~v.startswith(HEADER_PREFIX) & (java_trim(v) != ""))


def _typed_fields(require_category: bool) -> tuple[list[Column], Column]:
    parts = F.split(F.col("value"), ",", -1)
    user = parse_long(split_field(parts, 0))
    item = parse_long(split_field(parts, 1))
    cat = parse_int(split_field(parts, 2))
    btype = F.lower(java_trim(split_field(parts, 3)))
    ts = parse_long(split_field(parts, 4))
    arity_ok = F.size(parts) >= _LOG_ARITY
    numbers_ok = user.isNotNull() & item.isNotNull() & ts.isNotNull()
    if require_category:
        numbers_ok = numbers_ok & cat.isNotNull()
    reason = (F.when(~arity_ok, F.lit("arity"))
              .when(~numbers_ok, F.lit("number")))
    cols = [user.alias("user_id"), item.alias("item_id"), cat.alias("category_id"),
            btype.alias("behavior_type"), ts.alias("ts")]
    return cols, reason


def parse_behavior_lines(lines: DataFrame, require_category: bool = True,
                         keep: Sequence[str] = ()) -> DataFrame:
    """Typed behaviour records from ``value`` lines; unparsable lines dropped.

    ``require_category=False`` is the lenient parse that never reads the
    category field (a bad category keeps the row; ``category_id`` may then
    be null).  ``keep`` lists extra input columns carried through.
    """
    cols, reason = _typed_fields(require_category)
    extra = [F.col(c) for c in keep]
    return (_data_lines(lines)
            .select(*cols, *extra, reason.alias("_reject"))
            .where(F.col("_reject").isNull())
            .drop("_reject"))


def rejected_lines(lines: DataFrame, require_category: bool = True) -> DataFrame:
    """The complement of :func:`parse_behavior_lines`: ``(value, reason)``.

    ``reason`` is ``arity`` (fewer than five fields) or ``number`` (a numeric
    field does not parse).  Header and blank lines are skipped, not rejected.
    """
    _, reason = _typed_fields(require_category)
    return (_data_lines(lines)
            .select("value", reason.alias("reason"))
            .where(F.col("reason").isNotNull()))


def line_stats(lines: DataFrame, require_category: bool = True) -> DataFrame:
    """One row of line counts: all, header, blank, data, rejected (by reason), parsed.

    A single aggregation over the lines (the data-quality view of the parse).
    """
    routed = route_lines(lines, require_category)
    return routed.agg(*[c.alias(k) for k, c in route_counts().items()])


# ---- one parse for all kinds of lines

LOG, REJECTED, HEADER, BLANK = "log", "rejected", "header", "blank"


def route_lines(lines: DataFrame, require_category: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Every line once, with where it belongs: ``route`` (log, rejected, header, blank), ``reason`` and ``value``
    (of lines outside the log), the typed columns (of the log) and ``keep``."""
    v = F.col("value")
    cols, reason = _typed_fields(require_category)
    route = (F.when(v.startswith(HEADER_PREFIX), HEADER).when(java_trim(v) == "", BLANK)
             .when(reason.isNotNull(), REJECTED).otherwise(LOG))
    names = [f.name for f in BEHAVIOR_SCHEMA]
    routed = lines.select(v, route.alias("route"), reason.alias("reason"), *cols, *keep)
    return routed.select(
        "route", F.when(F.col("route") == REJECTED, F.col("reason")).alias("reason"),
        F.when(F.col("route") != LOG, v).alias("value"), *[F.when(F.col("route") == LOG, F.col(c)).alias(c) for c in names], *keep)


def route_counts() -> dict[str, Column]:
    """Aggregates over :func:`route_lines`: lines by kind."""
    route, reason = F.col("route"), F.col("reason")
    return {"n_lines": F.count(F.lit(1)), "n_header": F.count_if(route == HEADER), "n_blank": F.count_if(route == BLANK),
            "n_data": F.count_if(route.isin(LOG, REJECTED)), "n_rejected_arity": F.count_if(reason == "arity"),
            "n_rejected_number": F.count_if(reason == "number"), "n_parsed": F.count_if(route == LOG)}


@dataclass
class Routes:
    """Lines parsed in one scan and written by ``route``; each frame reads its own folder only."""

    path: str
    log: DataFrame             # typed columns and those kept
    rejected: DataFrame        # (value, reason)
    header: DataFrame          # (value)
    blank: DataFrame           # (value)
    counts: dict               # route_counts and the further metrics asked for


def write_routes(lines: DataFrame, require_category: bool = True, keep: Sequence[str] = (), **metrics: Column) -> Routes:
    """Parse ``lines`` once, write them to a folder a route, and count them on the way.

    ``metrics`` are further aggregates over :func:`route_lines`.
    """
    spark, path = lines.sparkSession, scratch_path(lines.sparkSession, "routes")
    routed = route_lines(lines, require_category, keep)
    _, counts = observed(routed, lambda df: df.write.partitionBy("route").parquet(path), **route_counts(), **metrics)
    back = spark.read.schema(routed.schema).parquet(path)
    names = [f.name for f in BEHAVIOR_SCHEMA]

    def of(route: str, *columns: str) -> DataFrame:
        return back.where(F.col("route") == route).select(*columns)

    return Routes(path, of(LOG, *names, *keep), of(REJECTED, "value", "reason"), of(HEADER, "value"), of(BLANK, "value"), counts)


def read_behavior_log(spark: SparkSession, paths: str | Sequence[str],
                      require_category: bool = True) -> DataFrame:
    return parse_behavior_lines(read_lines(spark, paths), require_category)


def parse_user_ids(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Distinct first-field user ids of every non-header, non-blank line.

    Any such line counts, also one the log parser would reject.  ``strict``
    fails the job on a first field that is not an integer; otherwise such
    lines are skipped.
    """
    first = java_trim(split_field(F.split(F.col("value"), ",", -1), 0))
    uid = parse_long(first)
    if strict:
        uid = F.when(uid.isNull(),
                     F.raise_error(F.concat(F.lit("bad user id in line: "), F.col("value")))
                     ).otherwise(uid)
    out = _data_lines(lines).select(uid.alias("user_id"))
    if not strict:
        out = out.where(F.col("user_id").isNotNull())
    return out.distinct()


def read_user_ids(spark: SparkSession, paths: str | Sequence[str], strict: bool = True) -> DataFrame:
    return parse_user_ids(read_lines(spark, paths), strict)


def parse_user_features(lines: DataFrame) -> DataFrame:
    """``user,f1,f2,f3`` lines -> ``(user_id, f1, f2, f3)``; bad lines dropped.

    Lines with fewer than four fields or an unparsable number are skipped;
    fields past the fourth are ignored.  Numbers follow the JVM's rules:
    ``NaN`` and ``Infinity`` are values, ``nan`` and ``inf`` are not.
    """
    parts = F.split(F.col("value"), ",", -1)
    user = parse_long(split_field(parts, 0))
    fs = [parse_double(split_field(parts, i)) for i in (1, 2, 3)]
    ok = (F.size(parts) >= _FEATURE_ARITY) & user.isNotNull()
    for f in fs:
        ok = ok & f.isNotNull()
    return (lines.where(java_trim(F.col("value")) != "")
            .select(user.alias("user_id"), *[f.alias(f"f{i}") for i, f in enumerate(fs, 1)],
                    ok.alias("_ok"))
            .where("_ok").drop("_ok"))


def read_user_features(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return parse_user_features(read_lines(spark, paths))
