"""Tar archives as tables: members, member bodies, and records in them. Compression is detected, not named.

Names come first: a task seeks from header to header of an archive and reads 512 bytes for each member, never a body.
Bodies of the members that are wanted are then read by where they stand, in splits of about SPLIT_BYTES, so one large
archive is read by many tasks, and a filter on names costs no bodies. A compressed archive cannot be entered in the
middle: it streams through one task, a member at a time.
"""

from __future__ import annotations

import tarfile
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry import schemas
from docketry.functions import scalars as S
from docketry.sources.readers import file_system, list_files

#: Members, and bytes of their bodies, that are handed on together.
BATCH_ROWS, BATCH_BYTES = 4096, 8 << 20
#: Bytes of an archive that a task reads at a time.
SPLIT_BYTES = 64 << 20

_MEMBERS = "path string, member string, size long, offset long"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())
    names = ("path", "member", "size", "offset", "body")
    width = len(rows[0])
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in zip(range(width), kinds)], names=names[:width])


def _batched(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for r in rows:
        held.append(r)
        size += len(r[4] or b"") if len(r) > 4 else 0
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


class _Compressed(Exception):
    pass


def _headers(f: BinaryIO) -> Iterator[tarfile.TarInfo]:
    """Regular members of a plain archive, by seeking."""
    head = f.read(6)
    if head[:2] == b"\x1f\x8b" or head[:3] == b"BZh" or head == b"\xfd7zXZ\0":
        raise _Compressed
    f.seek(0)
    with tarfile.open(fileobj=f, mode="r:") as tar:
        for m in tar:
            tar.members = []  # else the archive keeps every member it has seen
            if m.isfile():
                yield m


def _streamed(f: BinaryIO, bodies: bool) -> Iterator[tuple[tarfile.TarInfo, bytes | None]]:
    with tarfile.open(fileobj=f, mode="r|*") as tar:
        for m in tar:
            tar.members = []
            if m.isfile():
                yield m, tar.extractfile(m).read() if bodies else None


def _names(path: str, suffix: str | None) -> Iterator[tuple[str, str, int, int]]:
    """(path, member, size, offset); the offset is null in a compressed archive."""
    store, p = file_system(path)

    def wanted(m: tarfile.TarInfo) -> bool:
        return suffix is None or m.name.endswith(suffix)

    try:
        with store.open_input_file(p) as f:
            yield from ((path, m.name, m.size, m.offset_data) for m in _headers(f) if wanted(m))
    except _Compressed:
        with store.open_input_stream(p, compression=None) as f:
            yield from ((path, m.name, m.size, None) for m, _ in _streamed(f, False) if wanted(m))


def read_tar_members(spark: SparkSession, path: str, bodies: bool = False, suffix: str | None = None, years: list[int] | None = None, courts: list[str] | None = None, benches: list[str] | None = None) -> DataFrame:
    """(path, part, member, name, size[, body]) of the regular files in all archives below a path.

    With years, courts or benches, only those partition folders are listed. Members whose name does not end with
    `suffix` are left out before any body is read. A damaged archive is an error.
    """
    only = {k: {str(v) for v in vs} for k, vs in (("year", years), ("court", courts), ("bench", benches)) if vs}
    files = list_files(spark, path, "*", only)
    archives = files.where(F.lower("path").rlike(r"\.tar(\.gz)?$")).select("path", "size")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.column(0).to_pylist():
                yield from _batched(_names(p, suffix))

    members = archives.repartition(max(1, spark.sparkContext.defaultParallelism * 4), "path").mapInArrow(look, _MEMBERS)
    if bodies:
        members = read_bodies(members, archives, suffix)
    columns = ["path", S.basename(F.col("path")).alias("part"), "member", S.basename(F.col("member")).alias("name"), "size"]
    return members.select(*columns, *(["body"] if bodies else []))


def read_bodies(members: DataFrame, archives: DataFrame, suffix: str | None = None) -> DataFrame:
    """members (path, member, size, offset) with `body`. archives (path, size) say how many splits there are at least.

    Members of a split stand together in the order of the archive, so a task opens an archive once for each split. Of a
    compressed archive (no offset) all members whose name ends with suffix are read.
    """
    spark = members.sparkSession
    total = archives.agg(F.sum("size")).first()[0] or 0
    # The rows are names only, so their size says nothing of the work; the number of partitions is told by the bytes.
    parts = max(spark.sparkContext.defaultParallelism, total // SPLIT_BYTES + 1)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, BinaryIO] | None = None

        def rows() -> Iterator[tuple]:
            nonlocal opened
            for b in batches:
                for p, member, size, offset in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                    if opened is None or opened[0] != p:
                        if opened:
                            opened[1].close()
                        store, inner = file_system(p)
                        opened = (p, store.open_input_file(inner))
                    opened[1].seek(offset)
                    body = opened[1].read(size)
                    if len(body) < size:
                        raise EOFError(f"{p} ends within {member}")
                    yield p, member, size, offset, body

        try:
            yield from _batched(rows())
        finally:
            if opened:
                opened[1].close()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.column(0).to_pylist():
                store, inner = file_system(p)
                with store.open_input_stream(inner, compression=None) as f:
                    yield from _batched((p, m.name, m.size, None, body) for m, body in _streamed(f, True) if suffix is None or m.name.endswith(suffix))

    where = members.where("offset is not null").withColumn("split", F.expr(f"offset div {SPLIT_BYTES}"))
    plain = where.repartition(int(parts), "path", "split").sortWithinPartitions("path", "offset").drop("split").mapInArrow(ranges, _MEMBERS + ", body binary")
    compressed = members.where("offset is null").select("path").distinct().repartition(int(parts), "path").mapInArrow(stream, _MEMBERS + ", body binary")
    return plain.unionByName(compressed)


def read_tar_records(spark: SparkSession, path: str) -> DataFrame:
    """Raw records in the JSON members of archives, with `path` and `member`."""
    rows = read_tar_members(spark, path, bodies=True, suffix=".json")
    record = F.from_json(F.col("body").cast("string"), schemas.struct(schemas.RAW_RECORD))
    return rows.select("path", "member", record.alias("r")).select("path", "member", "r.*").withColumn("has_html", F.col("raw_html").isNotNull())
