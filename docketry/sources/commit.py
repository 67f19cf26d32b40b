"""Replacing leaves of a partitioned layer as a whole, so that a commit that was cut off can be finished.

All new leaves are written beside the layer first, and a list of them last: without the list nothing has happened yet,
and with it every leaf can be moved into place, in any order and more than once. A leaf that loses all its rows is
replaced by a file without rows, which keeps its schema. The layer and the stage must be of one file system; a reader
may miss a leaf for the moment between two renames.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from docketry import schemas

_READY = "leaves"
_LEAF = re.compile(r"([^/]+/[^/]+/[^/]+)/[^/]+$")


class Folders:
    """The few operations on folders that a commit needs, on the Hadoop file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self._conf)

    def path(self, p: str):
        return self._hadoop.Path(p)

    def exists(self, p: str) -> bool:
        return self.fs.exists(self.path(p))

    def below(self, p: str, levels: int) -> list[str]:
        """Paths, relative to p, of the folders `levels` below it."""
        found = self.fs.globStatus(self.path(p + "/*" * levels)) or []
        return sorted("/".join(f.getPath().toString().split("/")[-levels:]) for f in found if f.isDirectory())

    def move(self, a: str, b: str) -> None:
        self.fs.mkdirs(self.path(b).getParent())
        if not self.fs.rename(self.path(a), self.path(b)):
            raise OSError(f"could not move {a} to {b}")

    def copy(self, a: str, b: str) -> None:
        self._hadoop.FileUtil.copy(self.fs, self.path(a), self.fs, self.path(b), False, self._conf)

    def files(self, p: str) -> list[str]:
        return [f.getPath().toString() for f in self.fs.listStatus(self.path(p)) if f.isFile() and f.getPath().getName()[0] not in "._"]

    def write(self, p: str, text: str) -> None:
        out = self.fs.create(self.path(p + ".part"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(p + ".part", p)

    def read(self, p: str) -> str:
        size = self.fs.getFileStatus(self.path(p)).getLen()
        stream = self.fs.open(self.path(p))
        try:
            return bytes(stream.readNBytes(int(size))).decode()
        finally:
            stream.close()

    def delete(self, p: str) -> None:
        self.fs.delete(self.path(p), True)


def leaf_folders(paths: DataFrame, column: str = "path") -> list[str]:
    """Folders, relative to their layer, of the files that the column names: one per leaf."""
    from pyspark.sql import functions as F

    folders = paths.select(F.regexp_extract(column, _LEAF.pattern, 1).alias("leaf")).distinct().collect()
    return sorted(unquote(r["leaf"]) for r in folders)


def stage_leaves(df: DataFrame, there: list[str], root: str, stage: str, write: Callable[[DataFrame, str], None]) -> str:
    """Write df as the new leaves of root, and empty ones for those of `there` that df has no row of; returns the commit's folder.

    df may read what it replaces. write(df, path) writes a layer.
    """
    spark = df.sparkSession
    at = f"{stage.rstrip('/')}/{uuid.uuid4().hex}"
    write(df, f"{at}/new")
    folders = Folders(spark, at)
    leaves = folders.below(f"{at}/new", len(schemas.PARTITIONS))
    emptied = sorted(set(there) - set(leaves))
    if emptied:
        spark.createDataFrame([], schemas.struct(schemas.JUDGMENT)).coalesce(1).write.parquet(f"{at}/empty")
        (empty,) = folders.files(f"{at}/empty")
        for leaf in emptied:
            folders.copy(empty, f"{at}/new/{leaf}/{empty.rpartition('/')[2]}")
    folders.write(f"{at}/{_READY}", "\n".join([root.rstrip("/"), *leaves, *emptied]))
    return at


def finish_commit(spark: SparkSession, at: str) -> int:
    """Move the leaves of a staged commit into place, those that are not there yet; returns how many were moved."""
    folders = Folders(spark, at)
    root, *leaves = folders.read(f"{at}/{_READY}").split("\n")
    moved = 0
    for leaf in leaves:
        new, old, place = f"{at}/new/{leaf}", f"{at}/old/{leaf}", f"{root}/{leaf}"
        if not folders.exists(new):
            continue
        if folders.exists(place):
            folders.move(place, old)
        folders.move(new, place)
        moved += 1
    folders.delete(at)
    return moved


def resume_commits(spark: SparkSession, stage: str) -> int:
    """Finish every commit below a stage that was cut off after its list was written, and remove those cut off before.

    Returns how many were finished. No other commit may be running in this stage.
    """
    folders = Folders(spark, stage)
    if not folders.exists(stage):
        return 0
    done = 0
    for name in folders.below(stage, 1):
        at = f"{stage.rstrip('/')}/{name}"
        if folders.exists(f"{at}/{_READY}"):
            finish_commit(spark, at)
            done += 1
        else:
            folders.delete(at)
    return done


def replace_leaves(df: DataFrame, there: list[str], root: str, stage: str, write: Callable[[DataFrame, str], None]) -> int:
    """Replace the leaves of root that df has rows of, and empty those of `there` (relative folders) that it has none of."""
    return finish_commit(df.sparkSession, stage_leaves(df, there, root, stage, write))
