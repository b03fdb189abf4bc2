"""Spark session defaults for the listings operators.

Everything here is plain Spark configuration. The settings that matter at
cluster scale are adaptive query execution (runtime re-planning of joins,
partition coalescing, skew-join splitting) and a UTC session zone so that
timestamps and month buckets mean the same thing on every executor.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings applied to every session this package builds. Shuffle partition
# count is left to the caller: on a cluster it should be sized to the data
# (AQE then coalesces small partitions), in tests it is the core count.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "parcelle",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.split("[")[0] == "local":
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read here.
    When it is unset, a fresh scratch folder is made on a plain local master
    only (tests); any other master raises, as executors would not share it.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if sc.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="parcelle-ckpt-",
                                   dir=os.environ.get("PARCELLE_SCRATCH", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, asked through the file system that the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies directly in a folder; none where there is no such folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


@contextmanager
def settings(spark: SparkSession, **values) -> Iterator[None]:
    """Session settings for the jobs that run inside, as they were afterwards; ``__`` in a name stands for a dot."""
    names = {name.replace("__", "."): str(value) for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
