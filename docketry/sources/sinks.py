"""Writers of the query layer, of reports and of archives."""

from __future__ import annotations

import functools
import io
import operator
import tarfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry import schemas
from docketry.functions import scalars as S
from docketry.operators import dedupe
from docketry.session import bounded_batches, scratch_path
from docketry.sources import commit
from docketry.sources.readers import file_system, parquet_footers, read_judgments


def write_judgments(df: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Partitioned Parquet with the fixed column order; each leaf is written whole by the tasks that hold it.

    Rows are ordered by decision date within files, so date predicates skip row groups.
    """
    cols = [F.col(c) if c in df.columns else F.lit(None).cast(schemas.struct(schemas.JUDGMENT)[c].dataType).alias(c) for c in schemas.JUDGMENT_COLUMNS]
    rows = df.select(*cols, *schemas.PARTITIONS).repartition(*schemas.PARTITIONS).sortWithinPartitions(*schemas.PARTITIONS, "decision_date")
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*schemas.PARTITIONS).parquet(root)


def combine(spark: SparkSession, paths: list[str], out: str, files: int = 1) -> None:
    """Parquet tables as one, columns by name; empty and unreadable files are passed over."""
    spark.read.option("ignoreCorruptFiles", True).option("mergeSchema", True).parquet(*paths).coalesce(files).write.mode("overwrite").parquet(out)


def combine_counted(spark: SparkSession, paths: list[str], out: str, files: int = 1) -> DataFrame:
    """As combine(), and one row of (files, unreadable, rows, rows_out): rows by the footers that can be read, and rows written.

    rows_out is less than rows where a file breaks off behind a footer that is whole. What is below the paths must not change
    meanwhile; they are folders on a store that pyarrow knows.
    """
    found = parquet_footers(spark, paths)
    combine(spark, paths, out, files)
    counts = found.agg(F.count("*").alias("files"), F.count("error").alias("unreadable"), F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"))
    return counts.crossJoin(spark.read.parquet(out).agg(F.count("*").alias("rows_out")))  # one row by one row


def _of_pairs(pairs: set[tuple[int, str]]) -> Column:
    """A filter on exactly these years and courts, which partitions are pruned by."""
    by_year: dict[int, list[str]] = {}
    for year, court in sorted(pairs):
        by_year.setdefault(year, []).append(court)
    return functools.reduce(operator.or_, [(F.col("year") == y) & F.col("court").isin(courts) for y, courts in by_year.items()])


def upsert_judgments(new: DataFrame, root: str, stage: str, keep_blank_keys: bool = False, in_turn: bool = True) -> None:
    """Merge rows into the leaves they belong to: the newest of a key wins, and keys of sibling benches win over it.

    in_turn decides leaf by leaf, as dedupe.upsert() says; without it, siblings are the leaves as they were before.

    new has the judgment columns, year, court, bench. Only leaves that new touches are rewritten; one that loses all its
    rows to siblings keeps a file without rows. A commit that an earlier call left unfinished is finished first.
    """
    spark = new.sparkSession
    commit.resume_commits(spark, stage)
    leaves = new.select(*schemas.PARTITIONS).distinct()
    touched = leaves.collect()  # one row per leaf of this batch
    if not touched:
        return
    there = read_judgments(spark, root, sorted({r["year"] for r in touched}), sorted({r["court"] for r in touched})).where(_of_pairs({(r["year"], r["court"]) for r in touched}))
    folders = commit.leaf_folders(there.join(F.broadcast(leaves), schemas.PARTITIONS, "left_semi"))
    commit.replace_leaves(dedupe.upsert(there.drop("path"), new, keep_blank_keys=keep_blank_keys, in_turn=in_turn), folders, root, stage, write_judgments)


def rewrite_changed(df: DataFrame, root: str, stage: str, write: bool = False) -> DataFrame:
    """Dedupe across files, latest file first; returns (path, rows_before, rows_after) and rewrites changed leaves if asked.

    df comes from read_judgments() with `mtime`. A leaf that loses all rows is rewritten too, as a file without rows.
    With `write` the report is stored before anything changes, since it tells of files that are gone then.
    """
    kept = dedupe.rewrite(df)
    before = df.groupBy("path").agg(F.count("*").alias("rows_before"))
    after = kept.groupBy("path").agg(F.count("*").alias("rows_after"))
    report = before.join(after, "path", "left").na.fill(0, ["rows_after"])
    if not write:
        return report
    spark = df.sparkSession
    commit.resume_commits(spark, stage)
    path = scratch_path(spark, "rewrite-report")
    report.write.parquet(path)
    report = spark.read.schema(report.schema).parquet(path)
    changed = report.where("rows_before <> rows_after").select("path")
    leaves = df.join(changed, "path", "left_semi").select(*schemas.PARTITIONS).distinct()
    folders = commit.leaf_folders(changed)
    if folders:
        rows = kept.join(leaves, schemas.PARTITIONS, "left_semi").select(*schemas.JUDGMENT_COLUMNS, *schemas.PARTITIONS)
        commit.replace_leaves(rows, folders, root, stage, write_judgments)
    return report


def write_report(df: DataFrame, path: str, kind: str = "csv") -> bool:
    """A CSV, TSV or JSON report in one file; an empty table writes nothing and returns False."""
    if df.isEmpty():
        return False
    out = df.coalesce(1).write.mode("overwrite")
    if kind == "json":
        out.json(path)
    else:
        out.option("header", True).option("sep", "\t" if kind == "tsv" else ",").csv(path)
    return True


def write_text_pages(pages: DataFrame, root: str) -> None:
    """Extracted pages as JSON lines by year, court and bench; no archive can overwrite another's."""
    pages.write.mode("append").partitionBy(*schemas.PARTITIONS).json(root)


def write_objects(df: DataFrame, folder: str) -> DataFrame:
    """Files below `folder` from rows (path, body); returns (path, size), which also makes the write happen when stored.

    A file appears whole: it is written under a name of its own and then moved, so a rerun task or a reader
    never sees half of it, and the last writer of a path wins.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        made: set[str] = set()
        for b in batches:
            sizes = []
            for path, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                where, _, name = f"{base}/{path}".rpartition("/")
                if where not in made:
                    store.create_dir(where, recursive=True)
                    made.add(where)
                temporary = f"{where}/.{name}-{uuid.uuid4().hex}"
                with store.open_output_stream(temporary, compression=None) as out:
                    out.write(body)
                store.move(temporary, f"{where}/{name}")
                sizes.append(len(body))
            yield pa.record_batch([b.column(0), pa.array(sizes, pa.int64())], names=["path", "size"])

    return df.select("path", F.col("body").cast("binary").alias("body")).mapInArrow(write, "path string, size long")


def write_indexes(indexes: DataFrame, folder: str) -> int:
    """Tar indexes as `<type>/tar/year=/court=/bench=/<type>.index.json` below `folder`, each replaced whole.

    indexes: data_type, year, court, bench, parts, and optionally scraped_through_date; counts and sizes are those
    of the parts. Returns how many were written.
    """
    zero = F.lit(0).cast("long")
    total = F.aggregate("parts", zero, lambda a, p: a + F.coalesce(p["size"], zero))
    doc = F.struct(
        F.aggregate("parts", zero, lambda a, p: a + F.size(p["files"])).alias("file_count"),
        total.alias("tar_size"),
        S.format_size(total).alias("tar_size_human"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"),
        *([F.col("scraped_through_date").cast("string").alias("scraped_through_date")] if "scraped_through_date" in indexes.columns else []),
        "parts",
    )
    path = S.index_path(F.col("data_type"), F.col("year"), F.col("court"), F.col("bench"))
    written = write_objects(indexes.select(path.alias("path"), F.to_json(doc).alias("body")), folder)
    return written.agg(F.count("*")).first()[0]


def write_cursors(new: DataFrame, old: DataFrame | None, path: str, keys: list[str]) -> None:
    """Cursors (keys, cursor) as a table at a fresh path: of each key the later one, so none moves back."""
    both = new if old is None else old.unionByName(new)
    both.groupBy(*keys).agg(F.max("cursor").alias("cursor")).write.mode("error").parquet(path)


def write_tar_parts(plan: DataFrame, folder: str) -> DataFrame:
    """Tar files of planned parts: plan has part, name and body. Returns (part, name, size) of the files written.

    The rows of a part arrive in the order of their names and go to the file as they come, so a task holds a batch of
    them, whatever the size of the part. A part appears whole, by a rename when its last member is written; a task that
    fails removes what it has begun, and the last writer of a part wins. A null body is an empty one.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        store.create_dir(base, recursive=True)
        part = out = tar = temporary = None

        def close() -> pa.RecordBatch:
            nonlocal part, temporary
            tar.close()
            size = out.tell()
            out.close()
            store.move(temporary, f"{base}/{part}.tar")
            temporary = None
            return pa.record_batch([pa.array([part]), pa.array([f"{part}.tar"]), pa.array([size], pa.int64())], names=["part", "name", "size"])

        try:
            for b in batches:
                for p, name, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                    if p != part:
                        if tar:
                            yield close()
                        part, temporary = p, f"{base}/.{p}-{uuid.uuid4().hex}"
                        out = store.open_output_stream(temporary, compression=None)
                        tar = tarfile.open(fileobj=out, mode="w|")  # members go to the file as they come
                    content = body.as_py() or b""
                    info = tarfile.TarInfo(name)
                    info.size = len(content)
                    tar.addfile(info, io.BytesIO(content))
                    tar.members = []  # else the archive keeps every member it has written
            if tar:
                yield close()
        finally:
            if temporary:
                out.close()
                store.delete_file(temporary)

    rows = bounded_batches(plan.select(F.col("part").cast("string").alias("part"), F.col("name").cast("string").alias("name"), F.col("body").cast("binary").alias("body")))
    return rows.repartition("part").sortWithinPartitions("part", "name").mapInArrow(pack, "part string, name string, size long")
