"""Session defaults (UTC, ANSI mode, adaptive execution), and folders that the driver and every executor share."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(app: str = "docketry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS; conf (with `_` for `.`) goes on top."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULTS, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; a local one is set only where none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="docketry-shared-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/") if "://" in root or root.startswith("file:") else "file://" + os.path.abspath(root)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it is removed when the driver ends."""
    path = f"{shared_root(spark)}/docketry/{name}-{uuid.uuid4().hex}"
    atexit.register(remove_path, spark, path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path of any Hadoop file system; a session that has ended already is left alone."""
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def bounded_batches(df: DataFrame, most: int = 4 << 20) -> DataFrame:
    """df, in a session whose Arrow batches hold about `most` bytes, however long its values are; a lower limit stays.

    Spark reads the limit when a plan runs, which may be after this call, so it is not put back.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    held = conf.get(key, None)
    if held is None or not held.isdigit() or int(held) > most:
        conf.set(key, str(most))
    return df


def small(df: DataFrame, most: int = 10_000) -> DataFrame:
    """df with the hint for its size: broadcast up to `most` rows, a merge join beyond."""
    return df.hint("broadcast") if len(df.limit(most + 1).select().take(most + 1)) <= most else df.hint("merge")
