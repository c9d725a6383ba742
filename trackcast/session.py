"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins from measured shuffle sizes
# (broadcast only when the runtime size is under the threshold) and splits
# skewed partitions; the session zone only matters for zoned timestamps, the
# library itself works on timestamp_ntz with zone-free arithmetic.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # broadcast only what is measured (AQE, at runtime) or estimated below
    # these bounds; everything larger stays a (skew-split) sort-merge join
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PySpark otherwise records the Python call site of every Column call
    # (extra JVM round trips + a stack walk each) for error messages only
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app: str = "trackcast", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` defaults to ``local[$BENCH_CPUS]`` when that is set; otherwise
    it is left to spark-submit (cluster) or Spark's own default.
    """
    builder = SparkSession.builder.appName(app)
    if master is None and os.environ.get("BENCH_CPUS"):
        master = f"local[{os.environ['BENCH_CPUS']}]"
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for work tables and lineage cuts: ``spark.checkpoint.dir``.

    A private folder is made only for a plain ``local[...]`` master whose
    setting is unset (tests, one-machine runs). On a cluster an unset folder is
    an error, because executors cannot see each other's local disks.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set; a cluster run needs a shared folder")
        current = tempfile.mkdtemp(prefix="trackcast-work-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def new_work_dir(spark: SparkSession, name: str) -> str:
    """Path of a new folder (not yet created) under the shared folder; no two calls give the same path."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def work_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once to the shared folder and read back, and where it lies: what is read more than
    once is computed once, and a lost executor costs a reread."""
    path = new_work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a work table through Hadoop's file system API (works on any store)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
