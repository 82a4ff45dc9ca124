"""Incremental per-user state: partial aggregates kept per split, refreshed from new splits only.

The features of a log that grows by splits (days, deliveries) need no rescan
of what was read before: a split's per-user aggregate merges with the
others'.  A state folder holds

* ``partials/<split>/v<version>``: the per-user aggregate of one split, a Parquet table;
* ``lineage/<run>``: what a refresh took in, one row a split: version,
  source paths, a fingerprint of the source's files (name, length and
  time of change), lines read and records kept.

A refresh lists each split's files and compares fingerprints with the newest
lineage of that split: unchanged splits are not read at all; a new or
changed one is parsed and aggregated into its next version, and only after
all of them are written is the lineage row added.  A refresh that dies half
way leaves versions that no lineage names, so the state stays what it was.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartograph.operators import features as FT
from cartograph.operators.clean import clean_behavior_log
from cartograph.schema import FEATURE_DECIMALS
from cartograph.session import materialize
from cartograph.sources import text as TX

LINEAGE = ("run long, split string, version int, source array<string>, fingerprint string, dropped boolean, "
           "n_lines long, n_records long")


@dataclass
class Refresh:
    run: int
    read: list[str]            # splits whose source was read
    unchanged: list[str]
    dropped: list[str]
    files: list[str]           # source files that were read


def source_files(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int, int]]:
    """(path, length, time of change) of the data files under ``paths``, in path order."""
    conf, out = spark.sparkContext._jsc.hadoopConfiguration(), []
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(conf)
        tops = fs.globStatus(at)
        if not tops:
            raise FileNotFoundError(path)
        for top in tops:
            found = fs.listFiles(top.getPath(), True)
            while found.hasNext():
                f = found.next()
                if not f.getPath().getName().startswith(("_", ".")):
                    out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def fingerprint(files: Sequence[tuple[str, int, int]]) -> str:
    return hashlib.sha256(repr(sorted(files)).encode()).hexdigest()


def lineage(spark: SparkSession, state: str) -> DataFrame:
    """All lineage rows of a state folder; none when it is new."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{state}/lineage")
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], LINEAGE)
    return spark.read.schema(LINEAGE).parquet(f"{state}/lineage/*")


def current(spark: SparkSession, state: str) -> dict[str, dict]:
    """Newest lineage row of every split (a row a split and run: a small table)."""
    newest = lineage(spark, state).groupBy("split").agg(F.max(F.struct("run", "version", "fingerprint", "dropped")).alias("l"))
    return {r["split"]: r["l"].asDict() for r in newest.collect()}


def refresh(spark: SparkSession, state: str, splits: Mapping[str, str | Sequence[str]]) -> Refresh:
    """Bring the state of ``splits`` (name -> log paths) up to date; reads new and changed splits only.

    A split that is no longer named is dropped from the state.
    """
    if bad := [n for n in splits if not re.fullmatch(r"[\w.-]+", n)]:
        raise ValueError(f"split names are folder names: {bad}")
    known = current(spark, state)
    run = 1 + max((k["run"] for k in known.values()), default=0)
    out, rows = Refresh(run, [], [], [], []), []
    for name, paths in splits.items():
        paths = [paths] if isinstance(paths, str) else list(paths)
        files = source_files(spark, paths)
        mark, last = fingerprint(files), known.get(name)
        if last and not last["dropped"] and last["fingerprint"] == mark:
            out.unchanged.append(name)
            continue
        version = last["version"] + 1 if last else 1
        routes = TX.write_routes(TX.read_lines(spark, paths))
        agg = FT.user_aggregate(clean_behavior_log(routes.log))
        # what is overwritten is a version that no lineage names
        agg.write.mode("overwrite").parquet(f"{state}/partials/{name}/v{version}")
        rows.append((run, name, version, paths, mark, False, routes.counts["n_lines"], routes.counts["n_parsed"]))
        out.read.append(name)
        out.files += [p for p, _, _ in files]
    for name, last in known.items():
        if name not in splits and not last["dropped"]:
            rows.append((run, name, last["version"], [], last["fingerprint"], True, 0, 0))
            out.dropped.append(name)
    if rows:
        spark.createDataFrame(rows, LINEAGE).coalesce(1).write.parquet(f"{state}/lineage/run-{run}")
    return out


def merged(spark: SparkSession, state: str) -> DataFrame:
    """Per-user aggregate over all current splits, from their partials alone."""
    parts = [spark.read.parquet(f"{state}/partials/{name}/v{last['version']}")
             for name, last in current(spark, state).items() if not last["dropped"]]
    if not parts:
        return spark.createDataFrame([], "user_id long, max_ts long, activity_count long, value_score double")
    return FT.merge_user_aggregates(*parts)


def features(spark: SparkSession, state: str, decimals: int | None = FEATURE_DECIMALS) -> DataFrame:
    """Scaled features of all current splits; cut-off and bounds come from the merged partials."""
    return FT.normalized_features_from_aggregate(materialize(merged(spark, state), "state-users"), decimals=decimals)
