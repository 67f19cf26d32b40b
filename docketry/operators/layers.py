"""Comparison of the layers that hold the same judgments: one long table, one shuffle by name.

Layers are rows (layer, partition columns, name[, size]); a comparison tags each name with the layers that hold
it and counts, rather than joining layer by layer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.functions import scalars as S


def sample(c: Column, n: int = 20) -> Column:
    """The first n distinct values in order, comma-joined; the same on every run. c should be few values: see few_names()."""
    return F.array_join(F.slice(F.array_sort(F.collect_set(c)), 1, n), ",")


#: Parts of a group whose first names are found apart.
SAMPLE_PARTS = 32


def few_names(rows: DataFrame, groups: list[str], name: str, n: int, to: str) -> DataFrame:
    """rows with a column `to`: the name, but null unless it is among the first n of its part of its group.

    A group's parts are by the hash of the name, so a group as large as the table is ranked by many tasks; the first n
    of the group are among at most SAMPLE_PARTS * n names that are left for sample() to collect.
    """
    part = F.pmod(F.xxhash64(name), F.lit(SAMPLE_PARTS))
    rank = F.row_number().over(Window.partitionBy(*groups, part).orderBy(F.col(name).asc_nulls_last()))
    return rows.withColumn(to, F.when(rank <= n, F.col(name)))


def flags(layers: DataFrame, names: list[str], keys: list[str], name: Column | str = "name") -> DataFrame:
    """(keys, name, one boolean per layer): which layers hold each name."""
    n = (F.col(name) if isinstance(name, str) else name).alias("name")
    return layers.groupBy(*keys, n).agg(*(F.bool_or(F.col("layer") == x).alias(x) for x in names))


def mask_histogram(layers: DataFrame, names: list[str], keys: list[str], n_sample: int = 20, name: Column | str = "name") -> DataFrame:
    """(keys, one boolean per layer, n, first): how many names are in exactly these layers, and candidates for their first ones.

    At most 2 ** len(names) rows per keys, whatever the number of names.
    """
    f = few_names(flags(layers, names, keys, name), [*keys, *names], "name", n_sample, "_first")
    return f.groupBy(*keys, *names).agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_set("_first")), 1, n_sample).alias("first"))


def matrix(layers: DataFrame, names: list[str], keys: list[str], n_sample: int = 20, name: Column | str = "name") -> DataFrame:
    """Per keys: size of each layer, and for each ordered pair the count and a sample of names in one but not the other.

    Columns: n_<a>, <a>_and_<b>, <a>_not_<b>, <a>_not_<b>_sample. All pairs come from the histogram of masks.
    """
    h = mask_histogram(layers, names, keys, n_sample, name)

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))

    cols = [total(F.col(a)).alias(f"n_{a}") for a in names]
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            if i < j:
                cols.append(total(F.col(a) & F.col(b)).alias(f"{a}_and_{b}"))
            if i != j:
                only = F.col(a) & ~F.col(b)
                first = F.slice(F.array_sort(F.flatten(F.collect_list(F.when(only, F.col("first"))))), 1, n_sample)
                cols += [total(only).alias(f"{a}_not_{b}"), F.array_join(first.cast("array<string>"), ",").alias(f"{a}_not_{b}_sample")]
    return h.groupBy(*keys).agg(*cols)


def as_pdf(name: Column) -> Column:
    """Names of metadata and PDF layers on one key."""
    return F.when(name.endswith(".json"), S.with_suffix(name, ".pdf")).otherwise(name)


def in_window(layers: DataFrame, start: str, end: str, date: Column | None = None) -> DataFrame:
    """Rows whose date (by default that in the name) lies in the window; rows without one do not."""
    d = S.filename_date(F.col("name")) if date is None else date
    return layers.where(d.between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def missing(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of left whose key is not in right; a key with a null is never in it."""
    return left.join(right.select(*on).distinct(), on, "left_anti")


def first_missing(left: DataFrame, right: DataFrame, on: list[str], keys: list[str], order: list[str], n: int = 20) -> DataFrame:
    """Of each of `keys` the first n rows of left, in `order`, whose `on` is not in right; with their rank."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return missing(left, right, on).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def compare_sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: distinct non-blank keys on each side, on both, and on one alone. Full outer on distinct keys."""

    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.where(F.col(key).isNotNull() & (F.col(key) != "")).select(F.col(key).alias("k")).distinct().withColumn(mark, F.lit(True))

    j = side(left, "l").join(side(right, "r"), "k", "full_outer")
    return j.agg(F.count("l").alias("left_unique"), F.count("r").alias("right_unique"), F.count_if(F.col("l") & F.col("r")).alias("both"), F.count_if(F.col("r").isNull()).alias("left_only"), F.count_if(F.col("l").isNull()).alias("right_only"))


def index_stats(indexes: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys: index files, declared counts, entries, distinct entries, duplicates (entries less distinct).

    Entries are distinct over all benches of the keys, by their raw names.
    """
    totals = indexes.groupBy(*keys).agg(F.count("*").alias("index_files"), F.sum("file_count").alias("file_count"))
    entries = indexes.select(*keys, F.explode(F.flatten("parts.files")).alias("file"))
    counted = entries.groupBy(*keys).agg(F.count("*").alias("entries"), F.countDistinct("file").alias("distinct_entries"))
    out = totals.join(counted, keys, "left").na.fill(0, ["entries", "distinct_entries"])
    return out.withColumn("duplicates", F.col("entries") - F.col("distinct_entries"))


def repeated_names(names: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """Per keys: rows beyond the first of each name."""
    return names.groupBy(*keys, name).agg(F.count("*").alias("n")).groupBy(*keys).agg(F.sum(F.col("n") - 1).alias("repeated"))


def object_stats(listing: DataFrame, keys: list[str]) -> DataFrame:
    return listing.groupBy(*keys).agg(F.count("*").alias("objects"), F.sum("size").alias("bytes"))


def table_stats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys of a scan with path (and file_size): files, rows, bytes of the files."""
    files = rows.groupBy(*keys, "path").agg(F.count("*").alias("n"), F.max("file_size").alias("file_size"))
    return files.groupBy(*keys).agg(F.count("*").alias("files"), F.sum("n").alias("rows"), F.sum("file_size").alias("bytes"))


def loose_records(raw: DataFrame, metadata_index: DataFrame, pdf_objects: DataFrame, data_index: DataFrame) -> DataFrame:
    """Raw records that no index of their bench lists, with whether their PDF is an object and is indexed.

    raw: bench, name (.json), ...; the others: bench, name.
    """
    loose = missing(raw, metadata_index, ["bench", "name"]).withColumn("pdf", S.with_suffix(F.col("name"), ".pdf"))
    a = pdf_objects.select("bench", F.col("name").alias("pdf")).distinct().withColumn("_a", F.lit(True))
    b = data_index.select("bench", F.col("name").alias("pdf")).distinct().withColumn("_b", F.lit(True))
    return loose.join(a, ["bench", "pdf"], "left").join(b, ["bench", "pdf"], "left").withColumns({"pdf_object": F.coalesce("_a", F.lit(False)), "pdf_indexed": F.coalesce("_b", F.lit(False))}).drop("_a", "_b")
