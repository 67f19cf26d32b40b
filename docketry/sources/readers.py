"""Readers of the layers. A path that does not exist is an empty layer; any other error stays an error."""

from __future__ import annotations

import fnmatch
import functools
import json
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry import schemas
from docketry.functions import scalars as S


#: How much of a delimited file is looked at for its separator.
SNIFF_CHARS, SNIFF_LINES = 4096, 1000


def _absent(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


def _or_empty(spark: SparkSession, read, schema: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if not _absent(e):
            raise
        return spark.createDataFrame([], schema)


def leaf_globs(root: str, years: list[int] | None = None, courts: list[str] | None = None, benches: list[str] | None = None) -> list[str]:
    """Globs of leaf folders; each filter works alone, so pruning survives a recursive read."""

    def one(name: str, values) -> str:
        return f"{name}={{{','.join(map(str, values))}}}" if values else f"{name}=*"

    return [f"{root.rstrip('/')}/{one('year', years)}/{one('court', courts)}/{one('bench', benches)}"]


def read_raw_records(spark: SparkSession, path: str) -> DataFrame:
    """Raw JSON records, one per file: schemas.RAW_RECORD, `has_html` (the key is there), `path`, and `corrupt`."""
    fields = schemas.struct(schemas.RAW_RECORD + ", corrupt string")
    reader = spark.read.schema(fields).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt")
    rows = _or_empty(spark, lambda: reader.json(path).withColumn("path", F.col("_metadata.file_path")), schemas.RAW_RECORD + ", corrupt string, path string")
    return rows.withColumn("has_html", F.col("raw_html").isNotNull())


def read_listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, name, size, mtime, year, court, bench) of the files below a path, empty ones too; bodies are not read.

    Folders are listed by tasks, through the file system that pyarrow knows for the path's URI. Where it knows none,
    Spark's own listing serves, which passes over files of no bytes. Names that start with a dot or an underscore
    are not listed.
    """
    p = F.col("path")
    return list_files(spark, path, glob).select("path", S.basename(p).alias("name"), "size", "mtime", S.path_year(p).alias("year"), S.path_part(p, "court").alias("court"), S.path_part(p, "bench").alias("bench"))


def list_files(spark: SparkSession, path: str, glob: str = "*", only: dict[str, set[str]] | None = None) -> DataFrame:
    """(path, size, mtime) of the files below a path, as read_listing() finds them.

    only: values of partition folders (`key=value`); other such folders are not listed.
    """
    found = _listed(spark, path, glob, only)
    if found is not None:
        return found
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    found = _or_empty(spark, lambda: reader.load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime")), _FILES)
    for key, values in (only or {}).items():
        value = S.path_part(F.col("path"), key)
        found = found.where(value.isNull() | value.isin(sorted(values)))
    return found


_FILES = "path string, size long, mtime timestamp"
#: Folders that the driver finds before it leaves the rest to tasks.
LISTED_APART = 256


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path in it) of a path with a scheme, whose names may hold spaces and percent signs."""
    return fs.FileSystem.from_uri(quote(path, safe="/:@"))


def _wanted(path: str, only: dict[str, set[str]]) -> bool:
    """Whether no folder `key=value` of the path has a value that `only` leaves out."""
    parts = (x.partition("=") for x in path.split("/"))
    return all(value in only[key] for key, eq, value in parts if eq and key in only)


def _listed(spark: SparkSession, path: str, glob: str, only: dict[str, set[str]] | None = None) -> DataFrame | None:
    """(path, size, mtime), or None if pyarrow has no file system for the path or the pattern is not a plain one.

    only: values of partition folders; other such folders are not listed.
    """
    only = only or {}
    if "{" in glob or any(c in path for c in "*?{["):
        return None
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    whole = re.sub(r"^file:/+", "file:///", whole)
    try:
        store, base = file_system(whole)
    except (pa.ArrowInvalid, OSError, ImportError):
        return None
    if store.get_file_info(base).type != fs.FileType.Directory:
        return spark.createDataFrame([], _FILES)
    prefix = whole[: len(whole) - len(base)] if whole.endswith(base) else None
    if prefix is None:
        return None
    apart: list[str] = []
    ahead = [base]
    while ahead and len(apart) + len(ahead) < LISTED_APART:
        below = [x.path for d in ahead for x in store.get_file_info(fs.FileSelector(d)) if x.type == fs.FileType.Directory and _wanted(x.path[len(base) :], only)]
        if not below:
            break
        apart, ahead = apart + ahead, below
    folders = [(d, False) for d in apart] + [(d, True) for d in ahead]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, _ = file_system(whole)
        for b in batches:
            for folder, deep in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                files = [x for x in here.get_file_info(fs.FileSelector(folder, recursive=deep)) if x.type == fs.FileType.File and x.base_name[0] not in "._" and fnmatch.fnmatchcase(x.base_name, glob) and _wanted(x.path[len(base) :], only)]
                columns = [pa.array([prefix + x.path for x in files], pa.string()), pa.array([x.size for x in files], pa.int64()), pa.array([x.mtime for x in files], pa.timestamp("us", "UTC"))]
                yield pa.record_batch(columns, names=["path", "size", "mtime"])

    n = min(len(folders), spark.sparkContext.defaultParallelism * 4)
    return spark.createDataFrame(folders, "folder string, deep boolean").repartition(n).mapInArrow(walk, _FILES)


def read_indexes(spark: SparkSession, path: str, data_type: str) -> DataFrame:
    """Tar indexes of a type, one row per partition, whichever of the two formats they have."""
    reader = spark.read.schema(schemas.struct(schemas.TAR_INDEX)).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", f"{data_type}.index.json")
    rows = _or_empty(spark, lambda: reader.json(path).withColumn("path", F.col("_metadata.file_path")), schemas.TAR_INDEX + ", path string")
    p = F.col("path")
    return normalize_index(rows).withColumns({"data_type": F.lit(data_type), "year": S.path_year(p), "court": S.path_part(p, "court"), "bench": S.path_part(p, "bench")})


def normalize_index(rows: DataFrame) -> DataFrame:
    """Flat indexes become one part; times become timestamps, with or without their `Z`."""
    whole = F.struct(F.lit("archive").alias("name"), F.coalesce("files", F.array().cast("array<string>")).alias("files"), F.size(F.coalesce("files", F.array().cast("array<string>"))).cast("long").alias("file_count"), F.col("tar_size").alias("size"), F.col("tar_size_human").alias("size_human"), F.col("created_at"))
    part = "array<struct<name:string,files:array<string>,file_count:bigint,size:bigint,size_human:string,created_at:string>>"
    flat = F.when(F.col("files").isNotNull(), F.array(whole)).otherwise(F.array()).cast(part)
    return rows.withColumn("parts", F.coalesce("parts", flat)).withColumn("updated_at", S.iso_timestamp(F.col("updated_at"))).drop("files", "created_at")


def index_files(indexes: DataFrame) -> DataFrame:
    """(partition columns, part, part_size, file, name): one row per entry of an index."""
    keys = [c for c in ("data_type", "year", "court", "bench") if c in indexes.columns]
    parts = indexes.select(*keys, F.explode("parts").alias("p"))
    rows = parts.select(*keys, F.col("p.name").alias("part"), F.col("p.size").alias("part_size"), F.explode("p.files").alias("file"))
    return rows.withColumn("name", S.basename(F.col("file")))


def read_judgments(spark: SparkSession, root: str, years: list[int] | None = None, courts: list[str] | None = None, benches: list[str] | None = None, rows: bool = False) -> DataFrame:
    """The query layer with its partition columns and `path`; `rows` adds `row`, the position in the file.

    Files may differ: this library's have the judgment columns; published ones have a column `court` (a name), which clashes
    with the partition `court` (a code), and dates as timestamps or nanoseconds. So the files' footers are looked at in
    tasks, files of one schema are read together with a mapping of their own, and the parts are united: the name
    becomes court_name, decision_date a DATE, and a column that a file lacks is null.

    years, courts and benches shorten the listing. Any filter on year, court and bench prunes: where no column
    clashes, partitions, else files by their paths, since Spark would give the partition's value for both.
    """
    filters = {k: {str(v) for v in vs} for k, vs in (("year", years), ("court", courts), ("bench", benches)) if vs}
    fields = f"{schemas.JUDGMENT}, year int, court string, bench string, path string" + (", row long" if rows else "")
    parts = [_read_class(spark, root, paths, example, rows) for example, paths in _file_classes(spark, root, filters)]
    if not parts:
        return spark.createDataFrame([], fields)
    df = functools.reduce(DataFrame.unionByName, parts)
    for name, values in (("year", years), ("court", courts), ("bench", benches)):
        df = df.where(F.col(name).isin(list(values))) if values else df
    return df


_KINDS = "leaf string, kind string, file string"


def _file_classes(spark: SparkSession, root: str, filters: dict[str, set[str]]) -> list[tuple[str, list[str]]]:
    """(a file, paths) for each schema among the files of a layer; paths are leaf folders, or files where a leaf is mixed."""
    known = {*schemas.JUDGMENT_COLUMNS, "court"}

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaves, kinds = [], []
            for path in b.column(0).to_pylist():
                store, p = file_system(path)
                with store.open_input_file(p) as f:
                    fields = pq.read_schema(f)
                kinds.append(json.dumps(sorted((x.name, str(x.type)) for x in fields if x.name in known)))
                leaves.append(path.rpartition("/")[0])
            yield pa.record_batch([pa.array(leaves, pa.string()), pa.array(kinds, pa.string()), b.column(0)], names=["leaf", "kind", "file"])

    found = _listed(spark, root, "*.parquet", filters)
    if found is None:
        files = _or_empty(spark, lambda: spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root).select("path"), "path string")
        # Spark alone knows this file system, so it looks at the files, one after the other.
        names = [r[0] for r in files.collect() if _wanted(r[0], filters)]
        looked = [(p.rpartition("/")[0], json.dumps(sorted(x for x in spark.read.parquet(p).dtypes if x[0] in known)), p) for p in names]
        found = spark.createDataFrame(looked, _KINDS)
    else:
        found = found.mapInArrow(footers, _KINDS)
    kinds = found.groupBy("leaf", "kind").agg(F.max("file").alias("file"), F.count("*").alias("n")).collect()  # one row per leaf and schema
    by_leaf: dict[str, list] = {}
    for r in kinds:
        by_leaf.setdefault(r["leaf"], []).append(r)
    mixed = [leaf for leaf, rs in by_leaf.items() if len(rs) > 1]
    out: dict[str, tuple[str, list[str]]] = {}
    for r in sorted(kinds):
        _, paths = out.setdefault(r["kind"], (r["file"], []))
        if len(by_leaf[r["leaf"]]) == 1:
            paths.append(r["leaf"])
    for r in found.where(F.col("leaf").isin(mixed)).collect() if mixed else []:
        out[r["kind"]][1].append(r["file"])
    if len(out) == 1 and not filters and not mixed:
        return [(example, [root]) for example, _ in out.values()]
    return list(out.values())


def _read_class(spark: SparkSession, root: str, paths: list[str], example: str, rows: bool) -> DataFrame:
    """Files of one schema, mapped to the judgment columns."""
    old = spark.conf.get("spark.sql.legacy.parquet.nanosAsLong", "false")
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        held = spark.read.parquet(example).schema
        reader = spark.read.option("pathGlobFilter", "*.parquet")
        wanted = T.StructType([f for f in held if f.name in {*schemas.JUDGMENT_COLUMNS, "court"}])
        clash = "court" in held.names
        if clash:
            df = reader.schema(wanted).option("recursiveFileLookup", True).parquet(*paths)
        else:
            df = reader.schema(T.StructType([*wanted, *schemas.struct("year int, court string, bench string")])).option("basePath", root).parquet(*paths)
    finally:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", old)
    p = F.col("_metadata.file_path")
    place = [S.path_year(p).alias("year"), S.path_part(p, "court").alias("court"), S.path_part(p, "bench").alias("bench")] if clash else [F.col(c) for c in schemas.PARTITIONS]

    def column(name: str, kind: str) -> Column:
        source = "court" if name == "court_name" and name not in held.names else name
        if source not in held.names or (source == "court" and not clash):
            return F.lit(None).cast(kind).alias(name)
        c = F.col(source)
        if name == "decision_date" and isinstance(held[source].dataType, T.LongType):
            c = F.timestamp_micros(F.expr("decision_date div 1000"))
        return c.cast(kind).alias(name)

    columns = [column(*x.split()) for x in schemas.JUDGMENT.split(", ")]
    return df.select(*columns, *place, p.alias("path"), *([F.col("_metadata.row_index").alias("row")] if rows else []))


def parquet_footers(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(path, rows, error) of the Parquet files below folders, by their footers, which tasks read; error tells why one cannot be.

    The folders must be on a store that pyarrow knows; one that is absent has no files.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, errors = [], []
            for path in b.column(0).to_pylist():
                store, p = file_system(path)
                with store.open_input_file(p) as f:
                    try:
                        rows.append(pq.read_metadata(f).num_rows)
                        errors.append(None)
                    except pa.ArrowInvalid as e:
                        rows.append(None)
                        errors.append(str(e))
            yield pa.record_batch([b.column(0), pa.array(rows, pa.int64()), pa.array(errors, pa.string())], names=["path", "rows", "error"])

    files = functools.reduce(DataFrame.union, [list_files(spark, x, "*.parquet").select("path") for x in folders])
    return files.mapInArrow(look, "path string, rows long, error string")


def sniff_separator(spark: SparkSession, path: str) -> str:
    """Tab or comma: the one that divides the lines of the first SNIFF_CHARS characters alike, outside quotes; then the commoner."""
    lines = "\n".join(r[0] for r in spark.read.text(path).limit(SNIFF_LINES).collect())[:SNIFF_CHARS]
    rows = re.sub(r'"(?:[^"]|"")*"', "", lines).splitlines() or [""]

    def score(sep: str) -> tuple[bool, int]:
        counts = [r.count(sep) for r in rows[: max(1, len(rows) - 1)]]  # the last line may be cut
        return min(counts) > 0 and min(counts) == max(counts), sum(counts)

    return "\t" if score("\t") > score(",") else ","


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """(value, path) of the lines of a run's logs, whether a file or a folder of them."""
    return _or_empty(spark, lambda: spark.read.option("recursiveFileLookup", True).text(path).select("value", F.col("_metadata.file_path").alias("path")), "value string, path string")


def read_delimited(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """A CSV or TSV table with a header, all columns text; the separator is sniffed if not given."""
    return spark.read.option("header", True).option("sep", sep or sniff_separator(spark, path)).csv(path)


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """Portal totals: court, court_name, year, portal_total (blank is 0)."""
    t = read_delimited(spark, path)
    return t.select("court", "court_name", F.col("year").cast("int"), S.lenient_int(F.col("portal_total")).alias("portal_total"))


def read_dictionary(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A JSON object, in the one file at or below path, as a table of two columns."""
    files = spark.read.text(path, wholetext=True).take(2)
    if len(files) != 1:
        raise ValueError(f"a dictionary is one file; {path} has {len(files) or 'none'}{' or more' * (len(files) > 1)}")
    return spark.createDataFrame(list(json.loads(files[0][0]).items()), f"{key} string, {value} string")


def read_benches(spark: SparkSession, path: str) -> DataFrame:
    """Bench dimension: court_name, court_code, bench_name."""
    return read_delimited(spark, path, ",").select("court_name", "court_code", "bench_name")


def discover_partitions(listing: DataFrame, path: Column | None = None) -> DataFrame:
    """Distinct (data_type, year, court, bench) of the index files in a listing, in order.

    A key counts if it is `<type>/tar/year=/court=/bench=/<type>.index.json` with a known type and a numeric year.
    """
    p = F.col("path") if path is None else path
    found = F.regexp_extract(p, r"(?:^|/)(data|metadata)/tar/year=(\d+)/court=[^/]+/bench=[^/]+/\1\.index\.json$", 1)
    rows = listing.where(found != "").select(found.alias("data_type"), S.path_year(p).alias("year"), S.path_part(p, "court").alias("court"), S.path_part(p, "bench").alias("bench"))
    return rows.distinct().orderBy("year", "court", "bench", "data_type")


def discover_data(listing: DataFrame, path: Column | None = None) -> DataFrame:
    """Distinct (data_type, year, court, bench) of the folders that hold any file, in order; the type is the first folder
    of those named data, metadata or parquet, and court and bench are null where the path has none."""
    p = F.col("path") if path is None else path
    kind = F.regexp_extract(p, r"(?:^|/)(data|metadata|parquet)(?:/[^/=]+)*/year=\d+/", 1)
    rows = listing.where(kind != "").select(kind.alias("data_type"), S.path_year(p).alias("year"), S.path_part(p, "court").alias("court"), S.path_part(p, "bench").alias("bench"))
    return rows.distinct().orderBy("year", "court", "bench", "data_type")


def pick_partitions(partitions: DataFrame, years: list[int] | None = None, courts: list[str] | None = None, limit: int | None = None) -> DataFrame:
    if years:
        partitions = partitions.where(F.col("year").isin(years))
    if courts:
        partitions = partitions.where(F.col("court").isin(courts))
    partitions = partitions.orderBy("year", "court", "bench", "data_type")
    return partitions.limit(limit) if limit else partitions


def parse_years(text: str | None) -> list[int] | None:
    """`2025,2026`, `1950-2026`, or both mixed; blank is no filter."""
    if not text or not text.strip():
        return None
    years: set[int] = set()
    for part in text.split(","):
        lo, _, hi = part.strip().partition("-")
        years.update(range(int(lo), int(hi or lo) + 1))
    return sorted(years)
