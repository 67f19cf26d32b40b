"""Folders that the driver and every executor share, and tables kept in them.

Intermediate results that several branches of a plan read are written as Parquet below
``spark.checkpoint.dir``: that cuts the lineage and survives a lost executor. Files that are not tables
(archives, token shards) go to the same place through :func:`open_filesystem`.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from docketry.session import remove_path, scratch_path, shared_root

__all__ = ["bounded_batches", "free_name", "open_filesystem", "remove_path", "scratch_path", "shared_root", "stored", "tidy"]

BATCH_BYTES = 4 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """df, in a session whose Arrow batches hold about BATCH_BYTES at most, however long the texts of a row are.

    Spark reads this limit when a plan runs, and an operator's plan may run long after the call, so the setting stays;
    one that is lower already is left alone.
    """
    conf = df.sparkSession.conf
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = conf.get(key, None)
    if held is None or df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(held) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def give_back() -> None:
    """Return to the system what Arrow and the C library (glibc only) keep of freed memory."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidy(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """f for mapInArrow, behind which the worker gives back the memory that it holds free.

    An executor keeps as many idle workers as a stage ever had at once; what each of them would hold adds up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores behind it until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_filesystem(uri: str):
    """(file system, path in it) of a URI, usable on executors."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)
