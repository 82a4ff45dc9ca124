"""Text sinks in the original output formats.

All writers refuse an existing output directory (``errorifexists``).  Only
results with a proven size bound (top pairs, K centres, top-k lines) are
coalesced to a single file.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartograph.functions.columns import format_fixed
from cartograph.operators.cooccur import ordered_pairs
from cartograph.schema import FEATURE_DECIMALS
from cartograph.session import materialize

_MODE = "errorifexists"
# lines of ordered pairs that reach a writer as one row
LINES_PER_ROW = 1000


def _write_lines(lines: DataFrame, path: str, single_file: bool = False, order: tuple = (), compression: str | None = None) -> None:
    """``order``: sort keys of a single file, applied inside its one partition."""
    if single_file:
        lines = lines.coalesce(1)
        if order:
            lines = lines.sortWithinPartitions(*order)
    lines.select("value").write.mode(_MODE).text(path, compression=compression)


def clean_log_lines(log: DataFrame) -> DataFrame:
    """``u,i,c,b,t`` per record."""
    return log.select(F.concat_ws(",", *[F.col(c).cast("string") for c in
                                         ("user_id", "item_id", "category_id", "behavior_type", "ts")]
                                  ).alias("value"))


def feature_lines(features: DataFrame, decimals: int = FEATURE_DECIMALS) -> DataFrame:
    """``user,f1,f2,f3`` with fixed decimals."""
    return features.select(F.concat_ws(",", F.col("user_id").cast("string"),
                                       *[format_fixed(c, decimals) for c in ("f1", "f2", "f3")]
                                       ).alias("value"))


def inverted_index_lines(index: DataFrame) -> DataFrame:
    """``item<TAB>user,user,...``: one line per item (per block of an item above the list bound)."""
    return index.select(F.concat(F.col("item_id").cast("string"), F.lit("\t"),
                                 F.array_join(F.col("user_ids").cast("array<string>"), ",")).alias("value"))


def cooccurrence_lines(pairs: DataFrame) -> DataFrame:
    """``a,b<TAB>n``."""
    a, b, n = (F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ("item_a", "item_b", "n_users"))
    return pairs.select("*", F.concat(a, F.lit(","), b, F.lit("\t"), n).alias("value"))


def _line_blocks(lines: int = LINES_PER_ROW):
    """For tasks: the lines of :func:`cooccurrence_lines` of three arrays, ``lines`` of them joined a row (a writer
    ends rows as it would end lines, so files are the same)."""
    def blocks(a, b, n):
        text = pc.binary_join_element_wise(pc.binary_join_element_wise(a.cast("string"), b.cast("string"), ","), n.cast("string"), "\t")
        ends = pa.array([*range(0, len(text), lines), len(text)], pa.int32())
        return pa.RecordBatch.from_arrays([pc.binary_join(pa.ListArray.from_arrays(ends, text), "\n")], ["value"])

    return blocks


def centre_lines(centres: DataFrame, decimals: int = FEATURE_DECIMALS) -> DataFrame:
    """``id<TAB>f1,f2,f3`` with fixed decimals."""
    return centres.select("*", F.concat(F.col("cluster_id").cast("string"), F.lit("\t"),
                                   F.concat_ws(",", *[format_fixed(c, decimals) for c in ("f1", "f2", "f3")])
                                   ).alias("value"))


def label_lines(labels: DataFrame) -> DataFrame:
    """``user,cluster``."""
    return labels.select(F.concat_ws(",", F.col("user_id").cast("string"),
                                     F.col("cluster_id").cast("string")).alias("value"))


def write_clean_log(log: DataFrame, path: str) -> None:
    _write_lines(clean_log_lines(log), path)


def write_user_features(features: DataFrame, path: str) -> None:
    _write_lines(feature_lines(features), path)


def write_inverted_index(index: DataFrame, path: str) -> None:
    _write_lines(inverted_index_lines(index), path)


def write_cooccurrence(top_pairs: DataFrame, path: str) -> None:
    """Top pairs (bounded by the report limit) in one file, most shared first."""
    _write_lines(cooccurrence_lines(top_pairs), path, single_file=True,
                 order=(F.col("n_users").desc(), F.col("item_a"), F.col("item_b")))


def write_cooccurrence_ordered(pairs: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """All pairs in several files, in one total order: most shared first, ties by ``item_a, item_b``.

    Each file is one partition of :func:`ordered_pairs`, a stretch of the order;
    files in name order, read line by line, are the ordered list.  ``pairs`` are read
    once.  ``compression``: codec of the files (``gzip``: about a fifth of the bytes; a
    file is read by one task then).  Returns the index of the files, one row each:
    ``file, n_lines, first_n_users, first_item_a, first_item_b, lines_before``.
    """
    _write_lines(ordered_pairs(pairs, form=_line_blocks(), schema="value string"), path, compression=compression)
    a, rest = F.substring_index("value", ",", 1), F.substring_index("value", ",", -1)
    key = {"first_n_users": F.substring_index(rest, "\t", -1), "first_item_a": a, "first_item_b": F.substring_index(rest, "\t", 1)}
    lines = pairs.sparkSession.read.text(path).select(
        "value", F.col("_metadata.file_name").alias("file"),
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("id"))
    # the first line of a file has its least key: lines are not sorted for it, and few are taken apart
    files = lines.groupBy("file").agg(F.count(F.lit(1)).alias("n_lines"), *[F.min_by(v.cast("bigint"), "id").alias(k) for k, v in key.items()])
    # one row a file: few enough for one running sum
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", "n_lines", *key, F.coalesce(F.sum("n_lines").over(before), F.lit(0)).alias("lines_before"))


def read_ordered_lines(spark: SparkSession, path: str, index: DataFrame) -> DataFrame:
    """``(line, value)``: the lines of :func:`write_cooccurrence_ordered` with their places in the order, from 0.

    No line is moved: a scan gives rows ids that rise line by line within a
    stretch of a file, so a first scan counts every stretch and finds its first id, and the
    second adds the lines before its stretch.  A stretch that the first scan did
    not see (files or read settings changed between the two) is an error.
    """
    at = ["part", "file", "start", "length"]
    lines = spark.read.text(path).select(
        "value", F.spark_partition_id().alias("part"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("id"))
    seen = lines.groupBy(*at).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # one row a stretch of a file
    stretches = materialize(seen.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
                            .join(F.broadcast(index.select("file", "lines_before")), "file")
                            .select(*at, (F.col("lines_before") + F.col("before") - F.col("first_id")).alias("shift")), "pair-stretches")
    known = F.when(F.col("shift").isNull(), F.raise_error(F.lit("the files or their splits changed while they were numbered")).cast("long"))
    return lines.join(F.broadcast(stretches), at, "left").select(
        known.otherwise(F.col("id") + F.col("shift")).cast("bigint").alias("line"), "value")


def write_centres(centres: DataFrame, path: str) -> None:
    _write_lines(centre_lines(centres), path, single_file=True, order=(F.col("cluster_id"),))


def write_labels(labels: DataFrame, path: str) -> None:
    _write_lines(label_lines(labels), path)


def write_recommendations(lines: DataFrame, path: str) -> None:
    """One ``target<TAB>item:score,...`` line per target (k entries each)."""
    _write_lines(lines, path, single_file=True)
