"""Spark session helpers.

Everything in the library works on a session handed in by the caller; this
module only builds one for tests, the bench and the command-line jobs, and
resolves the shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app_name: str = "tillflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs.

    On a cluster the launcher supplies master, memory and shuffle sizing;
    here we only pin what results depend on (UTC) and keep AQE on so that
    partition counts, skew splits and broadcast conversions are decided from
    runtime sizes instead of hard-coded guesses.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Bounds of one task's share of an exchange, unless the session names its own: rows are several times as large
# once they are read, joined and sorted, and a task holds the sorts of its joins and of its aggregate at once.
# Where every part of a side is as small as that, it is hashed and the other side need not be sorted.
TASK_BOUNDS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m"}


def bound_tasks(spark: SparkSession) -> None:
    """Bound the partitions that adaptive execution puts together (``TASK_BOUNDS``); all of them stay as they are if one is configured."""
    if not getattr(spark, "_tillflow_bounded", False):
        known = spark.sparkContext.getConf()
        default = {"67108864b", "64MB", "0b", "0"}
        if all(not known.contains(k) and spark.conf.get(k) in default for k in TASK_BOUNDS):
            for key, bound in TASK_BOUNDS.items():
                spark.conf.set(key, bound)
        spark._tillflow_bounded = True


RELEASE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def release_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of every action inside when it ends, not whenever the driver collects its garbage.

    A job of several written tables else keeps the exchanges of all of them on disk at once. Actions on frames
    share no exchange, so no later action misses the files.
    """
    before = spark.conf.get(RELEASE_CONF, None)
    spark.conf.set(RELEASE_CONF, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE_CONF) if before is None else spark.conf.set(RELEASE_CONF, before)


def is_local(spark: SparkSession) -> bool:
    """Driver and executors share one machine (``local-cluster`` counts as a cluster)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The value of ``spark.checkpoint.dir`` wins, then a folder already set on
    the Spark context. Only when both are unset in local mode (tests) a scratch
    folder is created and registered; on a cluster an unset value is an error
    rather than a machine-local folder.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    registered = spark.sparkContext.getCheckpointDir()
    if not path:
        path = registered
    if not path:
        if not is_local(spark):
            raise ValueError(f"{CHECKPOINT_CONF} is not set: name a folder every executor can reach")
        path = tempfile.mkdtemp(prefix="tillflow-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if registered is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for intermediate tables; it is deleted when the driver's JVM ends.

    Results are lazy and may read their scratch tables at any time, so the
    application owns the folder; ``clean_scratch`` deletes it earlier.
    """
    sc = spark.sparkContext
    root = os.path.join(ensure_checkpoint_dir(spark), "tables", sc.applicationId)
    if getattr(sc, "_tillflow_scratch", None) != root:
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        sc._tillflow_scratch = root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables under the shared checkpoint folder."""
    return os.path.join(scratch_root(spark), name)


def clean_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders whose results have been consumed (all of this application's without ``paths``)."""
    sc = spark.sparkContext
    for p in paths or (scratch_root(spark),):
        path = sc._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    if not paths:
        sc._tillflow_scratch = None
