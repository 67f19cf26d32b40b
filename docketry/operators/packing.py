"""Planning of tar parts: greedy packing in order, the part to append to, the index after an upload.

Packing is sequential within a partition. `greedy_parts` streams a partition's files in order through one task, which
holds a batch and two numbers at a time. `pack_large` cuts the files of a partition into chunks that many tasks
describe at once, each by what it makes of the bytes in the part that is open before it; only these descriptions are
walked in order. Where parts end is found by binary search in running sums, a step per part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.session import bounded_batches, scratch_path

# Most bytes of a part, and of a part that may still be appended to.
PART_LIMIT = 1 << 30
APPEND_LIMIT = 100 << 20
#: Most files of a chunk, of which a task holds the sizes at once.
CHUNK_FILES = 1 << 18


def _checked(df: DataFrame, name: str, size: str, limit: int) -> DataFrame:
    """df, failing at a file whose size is above the limit, below 0 or missing; the error names it."""
    wrong = F.raise_error(F.concat(F.lit("a file exceeds the limit of a part, or has no size: "), F.coalesce(F.col(name).cast("string"), F.lit("null")), F.lit(", "), F.coalesce(F.col(size).cast("string"), F.lit("null"))))
    return df.withColumn(size, F.when(F.col(size).between(0, limit), F.col(size)).otherwise(wrong.cast("long")))


def greedy_parts(files: DataFrame, keys: list[str], order: str, name: str = "name", size: str = "size", limit: int = PART_LIMIT) -> DataFrame:
    """(keys, part, name, size): files in order; a part is closed when it has files and the next would exceed limit.

    A file above the limit, or without a size, is an error that names it. Whether a part has files is told by count, since sizes may be 0.
    """
    rows = _checked(files, name, size, limit).select(*keys, F.col(order).alias("_order"), F.col(name).cast("string").alias("name"), F.col(size).cast("long").alias("size"))
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "_order", "name", "size").select(*keys, "name", "size")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part, used, held = None, 0, 0, False
        for b in batches:
            if not b.num_rows:
                continue
            columns = [b.column(i) for i in range(len(keys))]
            sums = np.append(0, np.cumsum(b.column(len(keys) + 1).to_numpy()))
            parts = np.zeros(b.num_rows, np.int32)
            for lo, hi in _runs(columns, b.num_rows):
                key = tuple(c[lo].as_py() for c in columns)
                if key != at:
                    at, part, used, held = key, 0, 0, False
                part, used, held = _fill(parts, sums, lo, hi, limit, part, used, held)
            yield pa.record_batch([*columns, pa.array(parts), *b.columns[-2:]], names=[*keys, "part", "name", "size"])

    return rows.mapInArrow(pack, f"{_fields(files, keys)}, part int, name string, size long")


def _fields(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)


def _runs(columns: list[pa.Array], n: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that are alike in all columns."""
    changes = np.zeros(n - 1, bool)
    for c in columns:
        changes |= ~np.asarray(_same(c[1:], c[:-1]))
    edges = [0, *(np.flatnonzero(changes) + 1).tolist(), n]
    return zip(edges[:-1], edges[1:], strict=True)


def _fill(parts: np.ndarray, sums: np.ndarray, lo: int, hi: int, limit: int, part: int, used: int, held: bool) -> tuple[int, int, bool]:
    """Write the parts of the files from lo to hi, with `part` open and `used` bytes in it; returns the state after them."""
    i = lo
    while i < hi:
        # The files that still fit; one always does in a part without files.
        j = min(hi, max(int(np.searchsorted(sums, sums[i] + limit - used, "right")) - 1, i if held else i + 1))
        parts[i:j] = part
        used, held = used + int(sums[j] - sums[i]), held or j > i
        if j < hi:
            part, used, held = part + 1, 0, False
        i = j
    return part, used, held


def _same(x: pa.Array, y: pa.Array) -> pa.Array:
    """Whether each value equals the other, nulls being equal."""
    both = pc.and_(pc.is_null(x), pc.is_null(y))
    return pc.or_(both, pc.fill_null(pc.equal(x, y), False))


def chunk_steps(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What files make of the part that is open before them, as steps (most, opened, left) ascending by most.

    The first step whose `most` is not below the bytes in the open part holds: so many parts are opened, and the last
    of them is left with so many bytes, or without a new part the open one gets so many more. Chains of parts that
    meet stay together, so equal steps are merged; there are no more than files in one part.
    """
    m = len(sizes)
    sums = np.append(0, np.cumsum(sizes))
    # Of a part that begins at each file: where the next one begins, and by pointer doubling where the last one does.
    then = np.searchsorted(sums, sums + limit, "right") - 1
    last, opened = np.where(then < m, then, np.arange(m + 1)), (then < m).astype(np.int64)
    while (more := opened[last]).any():
        opened, last = opened + more, last[last]
    start = np.arange(np.searchsorted(sums, limit, "right"))[::-1]
    opened, left = opened[start] + 1, sums[m] - sums[last[start]]
    whole = start == m  # all files fit the open part
    opened[whole], left[whole] = 0, sums[m]
    keep = np.append((np.diff(opened) != 0) | (np.diff(left) != 0), True)
    return (limit - sums[start])[keep], opened[keep], left[keep]


def pack_large(files: DataFrame, keys: str | list[str], order: str, name: str = "name", size: str = "size", limit: int = PART_LIMIT, chunk_files: int = CHUNK_FILES) -> DataFrame:
    """As greedy_parts(), with the files of a partition spread over tasks; a single key becomes text.

    Files are dealt in ranges of (keys, order, name, size) and stored in chunks with the steps of each. One row per
    chunk is then walked in order by partition, which gives each chunk the part and the bytes it begins with, and
    the chunks are filled on their own. Chunks of fewer files than a part holds have as many steps as files.
    """
    if isinstance(keys, str):
        files, keys = files.withColumn(keys, F.col(keys).cast("string")), [keys]
    spark, kinds, k = files.sparkSession, _fields(files, keys), len(keys)
    rows = _checked(files, name, size, limit).select(*keys, F.col(order).alias("_order"), F.col(name).cast("string").alias("name"), F.col(size).cast("long").alias("size"))
    by = [*keys, "_order", "name", "size"]
    rows = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by).select(*keys, "name", "size")
    described = pa.schema([("chunk", pa.int64()), ("at", pa.int64()), ("name", pa.string()), ("size", pa.int64()), *((x, pa.list_(pa.int64())) for x in ("most", "opened", "left"))])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, key, held, n = TaskContext.get().partitionId() << 32, None, [], 0
        own: list[pa.Array] = []

        def batch(columns: list[pa.Array], values: list[pa.Array]) -> pa.RecordBatch:
            return pa.record_batch([*columns, *values], names=[*keys, *described.names])

        def ended() -> pa.RecordBatch:
            steps = [pa.array([x], pa.list_(pa.int64())) for x in chunk_steps(np.concatenate(held), limit)]
            return batch(own, [pa.array([chunk]), pa.array([-1]), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), *steps])

        for b in batches:
            if not b.num_rows:
                continue
            columns = b.columns[:k]
            for lo, hi in _runs(columns, b.num_rows):
                here = tuple(c[lo].as_py() for c in columns)
                while lo < hi:
                    if n and (here != key or n == chunk_files):
                        yield ended()
                        chunk, held, n = chunk + 1, [], 0
                    key, own = here, [c[lo : lo + 1] for c in columns]
                    j = min(hi, lo + chunk_files - n)
                    held.append(b.column(k + 1)[lo:j].to_numpy())
                    yield batch([c[lo:j] for c in columns], [pa.array(np.full(j - lo, chunk)), pa.array(np.arange(n, n + j - lo)), b.column(k)[lo:j], b.column(k + 1)[lo:j], *(pa.nulls(j - lo, pa.list_(pa.int64())) for _ in range(3))])
                    lo, n = j, n + j - lo
        if n:
            yield ended()

    path = scratch_path(spark, "chunks")
    of_chunks = "chunk long, at long, name string, size long, most array<long>, opened array<long>, left array<long>"
    bounded_batches(rows).mapInArrow(describe, f"{kinds}, {of_chunks}").write.parquet(path)
    stored = spark.read.schema(f"{kinds}, {of_chunks}").parquet(path)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part, used = None, 0, 0
        for b in batches:
            parts, bytes_used = [], []
            for i in range(b.num_rows):
                here = tuple(c[i].as_py() for c in b.columns[:k])
                if here != key:
                    key, part, used = here, 0, 0
                parts.append(part)
                bytes_used.append(used)
                most, opened, left = (np.asarray(c[i].values) for c in b.columns[k + 1 :])
                step = int(np.searchsorted(most, used))
                part, used = part + int(opened[step]), int(left[step]) + (0 if opened[step] else used)
            yield pa.record_batch([*b.columns[: k + 1], pa.array(bytes_used, pa.int64()), pa.array(parts, pa.int32())], names=[*keys, "chunk", "size", "part"])

    steps = stored.where("at = -1").select(*keys, "chunk", "most", "opened", "left").repartition(*keys).sortWithinPartitions(*keys, "chunk")
    states = steps.mapInArrow(walk, f"{kinds}, chunk long, size long, part int")
    # The state that a chunk begins with comes before its files.
    listed = stored.where("at >= 0").select(*keys, "chunk", "at", "name", "size", F.lit(None).cast("int").alias("part"))
    listed = listed.unionByName(states.select(*keys, "chunk", F.lit(-1).cast("long").alias("at"), F.lit(None).cast("string").alias("name"), "size", "part"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, used = 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            first = np.asarray(b.column(k + 1)) < 0
            sizes = b.column(k + 3).to_numpy()
            sums, parts = np.append(0, np.cumsum(sizes)), np.zeros(b.num_rows, np.int32)
            edges = [0, *np.flatnonzero(first).tolist(), b.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo < hi and first[lo]:
                    part, used, lo = b.column(k + 4)[lo].as_py(), int(sizes[lo]), lo + 1
                part, used, _ = _fill(parts, sums, lo, hi, limit, part, used, True)
            out = pa.record_batch([*b.columns[:k], pa.array(parts), *b.columns[k + 2 : k + 4]], names=[*keys, "part", "name", "size"])
            yield out.filter(pa.array(~first))

    return listed.repartition("chunk").sortWithinPartitions("chunk", "at").mapInArrow(fill, f"{kinds}, part int, name string, size long")


def append_target(parts: DataFrame, keys: list[str], new_size: DataFrame, part_limit: int = PART_LIMIT, append_limit: int = APPEND_LIMIT) -> DataFrame:
    """(keys, name): the newest part of each partition, if it is small enough and takes the new bytes, else null.

    parts: keys, name, size, created_at (text or timestamp). new_size: keys, new_size.
    """
    newest = parts.groupBy(*keys).agg(F.max_by(F.struct("name", "size"), F.struct("created_at", "name")).alias("p"))
    fits = (F.col("p.size") <= append_limit) & (F.col("p.size") + F.col("new_size") <= part_limit)
    return new_size.join(newest, keys, "left").select(*keys, F.when(fits, F.col("p.name")).alias("name"))


def update_index(index: DataFrame, upload: DataFrame, keys: list[str]) -> DataFrame:
    """The index after an upload: new files that no part has yet become a part, or extend the part they name.

    index: keys, parts, ...; upload: keys, part, files, size, created_at, replaces (name of the part that the new
    one replaces, or null). Rows without anything new come back as they were, with changed = false.
    """
    j = index.join(upload.withColumnsRenamed({"files": "_files", "size": "_size", "created_at": "_at", "part": "_part", "replaces": "_old"}), keys, "left")
    kept = F.filter("parts", lambda p: F.col("_old").isNull() | (p["name"] != F.col("_old")))
    old = F.flatten(F.transform(F.filter("parts", lambda p: p["name"] == F.col("_old")), lambda p: p["files"]))
    there = F.flatten(F.transform("parts", lambda p: p["files"]))
    fresh = F.array_except(F.coalesce("_files", F.array().cast("array<string>")), there)
    files = F.concat(F.when(F.col("_old").isNotNull(), old).otherwise(F.array().cast("array<string>")), fresh)
    j = j.withColumns({"_fresh": F.size(fresh), "_all": files})
    part = F.struct(F.col("_part").alias("name"), F.col("_all").alias("files"), F.size("_all").cast("long").alias("file_count"), F.col("_size").cast("long").alias("size"), F.lit(None).cast("string").alias("size_human"), F.col("_at").alias("created_at"))
    changed = F.coalesce(F.col("_fresh") > 0, F.lit(False))
    j = j.withColumn("changed", changed).withColumn("parts", F.when(F.col("changed"), F.concat(kept, F.array(part))).otherwise(F.col("parts")))
    zero = F.lit(0).cast("long")
    return j.withColumns({"file_count": F.aggregate("parts", zero, lambda a, p: a + F.size(p["files"])), "tar_size": F.aggregate("parts", zero, lambda a, p: a + F.coalesce(p["size"], zero))}).select(*index.columns, *(c for c in ("file_count", "tar_size") if c not in index.columns), "changed")
