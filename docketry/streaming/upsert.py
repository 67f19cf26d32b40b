"""Incremental ingest as a stream: each micro-batch is merged into a table by key, the newest row winning.

Late rows replace older ones of their key whenever they come, which dropDuplicatesWithinWatermark (it keeps the
first) cannot do. The cursor table is written after the merge, so a batch that fails is merged again from its
checkpoint, to the same result.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketry.operators.dedupe import keep_last

#: Buckets of a table; a micro-batch rewrites those it touches.
BUCKETS = 64
_BUCKET = "_bucket"


class TableStore:
    """A Parquet table in buckets of a key, in numbered versions: a version is complete before the pointer names it.

    A write replaces the buckets it has rows of and leaves the others where they are: version n is a list of the
    folder of each bucket. Readers see the old version or the new one. Folders that neither of the two latest
    versions names are deleted.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str] | None = None, buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), keys or [], buckets if keys else 1
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return [str(s.getPath().getName()) for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def version(self) -> int:
        """The latest complete version, -1 if there is none."""
        return max((int(x[1:-5]) for x in self._names(f"{self.root}/versions") if re.fullmatch(r"v\d+\.json", x)), default=-1)

    def _folders(self, version: int) -> dict[str, str]:
        """Bucket to folder below the root."""
        if version < 0:
            return {}
        stream = self._fs.open(self._path(f"{self.root}/versions/v{version}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int") if self.keys else F.lit(0)

    def read(self, only: list[int] | None = None) -> DataFrame | None:
        """The latest version, or of it the given buckets; None where there is nothing."""
        folders = self._folders(self.version())
        paths = [f"{self.root}/{x}" for k, x in folders.items() if only is None or int(k) in only]
        return self.spark.read.parquet(*sorted(paths)) if paths else None

    def write(self, df: DataFrame) -> None:
        """A new version in which the buckets of df's rows hold just these rows."""
        v = self.version()
        old = self._folders(v)
        folder = f"data/{uuid.uuid4().hex}"
        df.withColumn(_BUCKET, self.bucket()).repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.root}/{folder}")
        new = {x.partition("=")[2]: f"{folder}/{x}" for x in self._names(f"{self.root}/{folder}") if x.startswith(f"{_BUCKET}=")}
        temporary, final = (self._path(f"{self.root}/versions/{x}") for x in (f".{uuid.uuid4().hex}", f"v{v + 1}.json"))
        out = self._fs.create(temporary)
        out.write(json.dumps(old | new).encode())
        out.close()
        self._fs.rename(temporary, final)
        kept = set(old.values()) | set((old | new).values())
        for k, x in self._folders(v - 1).items() if v > 0 else ():
            if x not in kept:
                self._fs.delete(self._path(f"{self.root}/{x}"), True)


def merge(store: TableStore, batch: DataFrame, keys: list[str], order: list[str]) -> None:
    """Upsert a batch: of each key the row that is last in `order` stays. Only buckets that the batch touches are read."""
    touched = [r[0] for r in batch.select(store.bucket()).distinct().collect()]  # as many as there are buckets, at most
    old = store.read(touched)
    both = batch if old is None else old.unionByName(batch, allowMissingColumns=True)
    store.write(keep_last(both, keys, [F.desc_nulls_last(c) for c in order]))


def upsert_stream(stream: DataFrame, root: str, checkpoint: str, keys: list[str], order: list[str], cursor: tuple[str, str] | None = None, after: Callable[[DataFrame, int], None] | None = None, ok: str | None = None) -> StreamingQuery:
    """Start merging a stream into the table at root/table, for all data that is there.

    cursor = (group, column): root/cursor then holds the latest value of column per group, which never moves
    back. `ok` names a boolean column: a batch moves the cursors of those groups only whose rows in it are all true.
    `after` runs when the merge is done and before the cursor moves, e.g. to write a raw layer: whoever sees what it
    writes finds the rows in the table.
    """
    spark = stream.sparkSession
    table = TableStore(spark, f"{root}/table", keys)
    cursors = TableStore(spark, f"{root}/cursor")

    def batch(df: DataFrame, number: int) -> None:
        if df.isEmpty():
            return
        merge(table, df, keys, order)
        if after:
            after(df, number)
        if cursor:
            group, column = cursor
            good = df if ok is None else df.join(df.groupBy(group).agg(F.bool_and(F.coalesce(ok, F.lit(False))).alias("_ok")).where("_ok").select(group), group, "left_semi")
            new = good.groupBy(group).agg(F.max(column).alias("cursor"))
            old = cursors.read()
            both = (new if old is None else old.unionByName(new)).groupBy(group).agg(F.max("cursor").alias("cursor"))
            if old is not None or not both.isEmpty():
                cursors.write(both)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, group: str, delay: str = "14 days", width: str = "1 day") -> DataFrame:
    """Counts per window and group with late data allowed up to `delay`; works on streams and tables."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), group).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), group, "n")


def read_events(spark: SparkSession, path: str, schema: str | None = None, files: int = 1) -> DataFrame:
    """Parquet files as a stream, so many a trigger; path is a folder or a single file."""
    if schema is None:
        try:
            schema = spark.read.parquet(path).schema
        except AnalysisException as e:
            raise ValueError(f"give a schema: nothing can be read at {path}") from e
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{path[:-1]}[{path[-1]}]")  # as a pattern, a file will do
