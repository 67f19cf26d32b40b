"""Integrity audit: one summary row per partition and one row per issue, from one pass over all layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.operators.layers import few_names, sample

KEYS = ["data_type", "year", "court", "bench"]
SAMPLE = 20

# Issue types in report order.
ISSUES = (
    "index_file_count_mismatch",
    "index_duplicate_entries",
    "raw_missing_index",
    "index_missing_raw",
    "missing_indexed_part_objects",
    "unindexed_tar_objects",
    "part_size_mismatch",
    "parquet_missing_data_index",
    "data_index_missing_parquet",
)
# Issues found inside tars; they do not change a partition's status.
MEMBER_ISSUES = ("part_index_files_missing_in_tar", "part_tar_members_missing_in_index")


def _pair(left: str, right: str, a: str, b: str) -> list[Column]:
    one, two = F.col(left) & ~F.col(right), F.col(right) & ~F.col(left)
    return [F.count_if(one).alias(f"{a}_n"), sample(F.when(one, F.col("_first")), SAMPLE).alias(f"{a}_s"), F.count_if(two).alias(f"{b}_n"), sample(F.when(two, F.col("_first")), SAMPLE).alias(f"{b}_s")]


def partition_summary(indexes: DataFrame, listing: DataFrame, parquet_names: DataFrame | None = None) -> DataFrame:
    """A row per partition with an index.

    indexes: KEYS, file_count, parts. listing: KEYS, layer (`raw` or `tar`), name, size. parquet_names: year,
    court, bench, name (PDF names of table rows), compared with data indexes only. Counts that do not apply are null.
    """
    base = indexes.select(*KEYS, F.col("file_count").alias("declared"), F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + F.size(p["files"])).alias("entries"), F.size(F.array_distinct(F.flatten("parts.files"))).cast("long").alias("distinct_entries"))
    files = indexes.select(*KEYS, F.explode(F.flatten("parts.files")).alias("file")).select(*KEYS, F.lit("index").alias("layer"), F.element_at(F.split("file", "/"), -1).alias("name"), F.lit(None).cast("long").alias("size"))
    parts = indexes.select(*KEYS, F.explode("parts").alias("p")).select(*KEYS, F.lit("part").alias("layer"), F.col("p.name").alias("name"), F.col("p.size").alias("size"))
    rows = files.unionByName(parts).unionByName(listing.select(*KEYS, "layer", "name", "size"))
    if parquet_names is not None:
        rows = rows.unionByName(parquet_names.select(F.lit("data").alias("data_type"), "year", "court", "bench", F.lit("parquet").alias("layer"), "name", F.lit(None).cast("long").alias("size")))
    kind = F.when(F.col("layer").isin("part", "tar"), "part").otherwise("file")  # parts and files may share names
    names = ("raw", "index", "part", "tar", "parquet")
    tagged = rows.groupBy(*KEYS, kind.alias("kind"), "name").agg(*(F.bool_or(F.col("layer") == x).alias(f"in_{x}") for x in names), F.max(F.when(F.col("layer") == "part", F.col("size"))).alias("declared_size"), F.max(F.when(F.col("layer") == "tar", F.col("size"))).alias("actual_size"))
    sizes = F.col("declared_size") != F.col("actual_size")
    tagged = few_names(tagged.withColumn("_sizes", F.coalesce(sizes, F.lit(False))), [*KEYS, "kind", *(f"in_{x}" for x in names), "_sizes"], "name", SAMPLE, "_first")
    found = tagged.groupBy(*KEYS).agg(
        F.count_if("in_raw").alias("raw_objects"),
        F.count_if("in_tar").alias("tar_objects"),
        F.sum("actual_size").alias("tar_bytes"),
        F.count_if("in_parquet").alias("parquet_names"),
        *_pair("in_raw", "in_index", "raw_missing_index", "index_missing_raw"),
        *_pair("in_part", "in_tar", "missing_indexed_part_objects", "unindexed_tar_objects"),
        F.count_if(sizes).alias("part_size_mismatch_n"),
        sample(F.when(sizes, F.col("_first")), SAMPLE).alias("part_size_mismatch_s"),
        *_pair("in_parquet", "in_index", "parquet_missing_data_index", "data_index_missing_parquet"),
    )
    out = base.join(found, KEYS, "left")
    out = out.withColumns({"index_file_count_mismatch_n": F.abs(F.col("declared") - F.col("entries")), "index_file_count_mismatch_s": F.concat_ws(",", F.col("declared").cast("string"), F.col("entries").cast("string")), "index_duplicate_entries_n": F.col("entries") - F.col("distinct_entries"), "index_duplicate_entries_s": F.lit("")})
    tables = (F.col("data_type") == "data") & F.lit(parquet_names is not None)
    for x in ("parquet_missing_data_index", "data_index_missing_parquet"):
        out = out.withColumns({f"{x}_n": F.when(tables, F.col(f"{x}_n")), f"{x}_s": F.when(tables, F.col(f"{x}_s"))})
    any_issue = F.lit(False)
    for x in ISSUES:
        any_issue = any_issue | (F.coalesce(f"{x}_n", F.lit(0)) > 0)
    return out.withColumn("status", F.when(any_issue, "issues").otherwise("ok"))


def issue_rows(summary: DataFrame) -> DataFrame:
    """(KEYS, issue, n, sample): the issues of each partition, in report order within it."""
    each = F.array(*(F.struct(F.lit(i).alias("at"), F.lit(x).alias("issue"), F.coalesce(f"{x}_n", F.lit(0)).cast("long").alias("n"), F.coalesce(f"{x}_s", F.lit("")).alias("sample")) for i, x in enumerate(ISSUES)))
    rows = summary.select(*KEYS, F.explode(F.filter(each, lambda s: s["n"] > 0)).alias("i"))
    return rows.select(*KEYS, "i.at", "i.issue", "i.n", "i.sample").orderBy("year", "court", "bench", "data_type", "at").drop("at")


def member_issues(index_files: DataFrame, members: DataFrame) -> DataFrame:
    """Files of an index that are not in their tar part, and the reverse: (KEYS, part, issue, n, sample).

    index_files and members: KEYS, part, name. Parts that are on one side only are left to partition_summary().
    """
    keys = [*KEYS, "part"]
    both = index_files.select(*keys, "name", F.lit("i").alias("l")).unionByName(members.select(*keys, "name", F.lit("t").alias("l")))
    tagged = both.groupBy(*keys, "name").agg(F.bool_or(F.col("l") == "i").alias("i"), F.bool_or(F.col("l") == "t").alias("t"))
    tagged = few_names(tagged, [*keys, "i", "t"], "name", SAMPLE, "_first")
    per = tagged.groupBy(*keys).agg(F.bool_or("i").alias("has_i"), F.bool_or("t").alias("has_t"), F.count_if(F.col("i") & ~F.col("t")).alias("n0"), sample(F.when(F.col("i") & ~F.col("t"), F.col("_first")), SAMPLE).alias("s0"), F.count_if(F.col("t") & ~F.col("i")).alias("n1"), sample(F.when(F.col("t") & ~F.col("i"), F.col("_first")), SAMPLE).alias("s1")).where("has_i and has_t")
    each = F.array(*(F.struct(F.lit(x).alias("issue"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("sample")) for i, x in enumerate(MEMBER_ISSUES)))
    return per.select(*keys, F.explode(F.filter(each, lambda s: s["n"] > 0)).alias("e")).select(*keys, "e.issue", "e.n", "e.sample")
