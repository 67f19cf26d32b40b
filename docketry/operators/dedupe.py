"""Identity of judgments: keep-last by key with an explicit order, sibling anti-join, upsert, rewrite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.functions import scalars as S

KEY = "_key"


def with_key(df: DataFrame, cnr: str = "cnr", date: str = "decision_date", link: str = "pdf_link") -> DataFrame:
    """df with its logical key; columns that df does not have count as missing."""

    def col(name: str) -> Column | None:
        return F.col(name) if name in df.columns else None

    return df.withColumn(KEY, S.logical_key(col(cnr), col(date), col(link)))


def keep_last(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Of each key the row that comes first in `order` (put the newest first); row_number = 1 is planned with a group limit."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def without_sibling_keys(df: DataFrame, siblings: DataFrame, partition: tuple[str, ...] = ("year", "court"), bench: str = "bench", keep_blank_keys: bool = False) -> DataFrame:
    """df without rows whose key exists in another bench of the same partition.

    A row without any identity has the key `pdf:`; such a key among siblings removes it too, unless
    keep_blank_keys exempts it.
    """
    mine, other = (x if KEY in x.columns else with_key(x) for x in (df, siblings))
    keys = other.select(*(F.col(c).alias(f"_s_{c}") for c in partition), F.col(bench).alias("_s_bench"), F.col(KEY).alias("_s_key")).distinct()
    same = (F.col(KEY) == F.col("_s_key")) & (F.col(bench) != F.col("_s_bench"))
    for c in partition:
        same &= F.col(c) == F.col(f"_s_{c}")
    if keep_blank_keys:
        same &= ~F.col(KEY).isin("", "pdf:")
    out = mine.join(keys, same, "left_anti")
    return out if KEY in df.columns else out.drop(KEY)


def upsert(existing: DataFrame, new: DataFrame, seq: str | None = None, keep_blank_keys: bool = False, in_turn: bool = False) -> DataFrame:
    """Leaves of `new` after the merge: new rows win over existing ones of their bench, siblings win over both.

    seq names an ingest sequence of new (higher is later); without it, rows of equal keys within new are
    ordered by their link.

    Siblings are the benches as published before, so a key that several benches of new hold already goes from all of
    them. With in_turn the result is that of one bench after the other, by name: each yields to what its siblings hold by
    then, so of a year and court one bench always keeps the key: the last that held it, else the first that brings it.
    """
    place = ["year", "court", "bench"]
    leaves = new.select(*place).distinct()
    own = existing.join(leaves, place, "left_semi").withColumn("_new", F.lit(0))
    both = with_key(own.unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True))
    order = [F.desc("_new"), *([F.desc_nulls_last(seq)] if seq else []), F.desc_nulls_last("pdf_link")]
    if not in_turn:
        merged = keep_last(both, [*place, KEY], order)
        # Published siblings: benches of the same year and court other than the row's own.
        return without_sibling_keys(merged, with_key(existing), keep_blank_keys=keep_blank_keys).drop("_new", KEY)
    # Both windows and the join that follows need no other partitioning than this one.
    both = both.repartition("year", "court", KEY).withColumn("_held", F.min("_new").over(Window.partitionBy(*place, KEY)) == 0)
    of_key = Window.partitionBy("year", "court", KEY)
    keeps = F.coalesce(F.max(F.when(F.col("_held"), F.col("bench"))).over(of_key), F.min("bench").over(of_key))
    blank = F.col(KEY).isin("", "pdf:") if keep_blank_keys else F.lit(False)
    merged = keep_last(both, [*place, KEY], order).withColumn("_keeps", keeps).where((F.col("bench") == F.col("_keeps")) | blank)
    untouched = existing.join(leaves, place, "left_anti")
    return without_sibling_keys(merged, with_key(untouched), keep_blank_keys=keep_blank_keys).drop("_new", "_held", "_keeps", KEY)


def rewrite(df: DataFrame) -> DataFrame:
    """Cross-file dedupe within year and court: the most recently modified file wins, then path, then row.

    df has mtime and path, and `row`, a row's position in its file (read_judgments(..., rows=True) gives it). Without
    it positions are those of the scan, which only agree with the file while it is read as one split.
    """
    rows = with_key(df).withColumn("_row", F.col("row") if "row" in df.columns else F.monotonically_increasing_id())
    order = [F.desc("mtime"), F.desc("path"), F.desc("_row")]
    return keep_last(rows, ["year", "court", KEY], order).drop("_row", KEY)


def duplicate_groups(df: DataFrame, key: str, value: str, least: int = 2) -> DataFrame:
    """(key, n, values ascending) of keys with `least` rows or more."""
    return df.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(F.count("*").alias("n"), F.array_sort(F.collect_set(value)).alias("values")).where(F.col("n") >= least)
