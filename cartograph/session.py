"""Session construction and the shared scratch folder."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings every cartograph job wants; callers on a cluster pass their own
# master / memory through spark-submit and keep these.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "cartograph",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be shared storage that survives executor loss; it
    is read from the session.  When it is unset, a folder under
    ``spark.sql.warehouse.dir`` is used with a warning if executors can reach
    it: always on a ``local`` master, else only where the path names a store
    other than the local file system.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = fallback_root(spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master)
        warnings.warn(f"spark.checkpoint.dir is not set; using {root}", stacklevel=2)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def fallback_root(warehouse: str, master: str) -> str:
    """Scratch folder under the warehouse; refused where it is one machine's own disk."""
    on_one_machine = master == "local" or master.startswith("local[")
    scheme = warehouse.partition(":")[0] if ":" in warehouse else ""
    if not on_one_machine and scheme in ("", "file"):
        raise ValueError(f"spark.checkpoint.dir is not set and {warehouse} is local to one machine: "
                         "set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse.rstrip('/')}/_cartograph_checkpoints"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never re-used location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/cartograph/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared folder and read it back.

    Cuts the lineage (nothing is recomputed from the source after an executor
    loss) and lets several later jobs share one computation without caching.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def observed(df: DataFrame, write: Callable[[DataFrame], object], **metrics: Column) -> tuple[object, dict]:
    """``write(df)`` and the aggregates ``metrics`` of the rows it writes, from the same job.

    The rows are observed in the stage that writes them, whose tasks count
    once each, also when executors are lost.
    """
    obs = Observation()
    out = write(df.observe(obs, *[c.alias(k) for k, c in metrics.items()]))
    return out, obs.get


def loop_session(spark: SparkSession, shuffle_partitions: int) -> SparkSession:
    """A session of its own for a loop whose shuffles are sized by its data.

    It shares the context and the catalog; settings and views are its own, so
    loops of several callers do not change each other's or the caller's.
    """
    own = spark.newSession()
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled",
                "spark.sql.adaptive.skewJoin.enabled", "spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.shuffle.partitions", str(max(1, int(shuffle_partitions))))
    return own


def tidy_session(spark: SparkSession) -> SparkSession:
    """A session of its own like :func:`loop_session`, for large tables written one after the other: the shuffle
    files of a write go when it ends, so disk holds those of one write at a time."""
    own = loop_session(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    own.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return own


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that this library wrote."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
