"""Per-user aggregate over a directory of arriving log text files.

The same parser, behaviour filter and per-user aggregate as the batch path,
applied to ``readStream.text``; the running aggregate is the streaming
counterpart of merging per-split aggregates.  Scaling to [0, 1] needs global
bounds and stays a batch step over a snapshot of the aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from cartograph.operators.clean import clean_behavior_log
from cartograph.operators.features import user_aggregate
from cartograph.sources.text import parse_behavior_lines


def stream_user_aggregates(spark: SparkSession, source_dir: str,
                           weights: Mapping[str, float] | None = None,
                           max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(user_id, max_ts, activity_count, value_score)``.

    Write it with ``outputMode("update")`` (changed users per micro-batch) or
    ``"complete"``; state is one row per user.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(source_dir)
    return user_aggregate(clean_behavior_log(parse_behavior_lines(lines)), weights)
