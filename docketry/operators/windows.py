"""Counts in a date window: histograms, tri-state counts, date semantics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window(df: DataFrame, start: str, end: str, column: str = "decision_date", year: str | None = "year") -> DataFrame:
    """Rows with a date in the window, both ends included. The years it spans go into the filter, so partitions prune."""
    out = df.where(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if year and year in df.columns:
        out = out.where(F.col(year).between(date.fromisoformat(start).year, date.fromisoformat(end).year))
    return out


def calendar(spark, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))


def daily_histogram(df: DataFrame, start: str, end: str, column: str = "decision_date", fill: bool = False) -> DataFrame:
    """(day, n) of the window; fill adds the days without rows."""
    counts = window(df, start, end, column).groupBy(F.col(column).cast("date").alias("day")).agg(F.count("*").alias("n"))
    if not fill:
        return counts
    return calendar(df.sparkSession, start, end).join(counts, "day", "left").na.fill(0, ["n"])


def window_totals(df: DataFrame, start: str, end: str, column: str = "decision_date") -> DataFrame:
    """Files, rows, rows with a date, and rows in the window."""
    inside = F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    files = F.countDistinct("path") if "path" in df.columns else F.lit(None).cast("long")
    return df.agg(files.alias("files"), F.count("*").alias("rows"), F.count(column).alias("dated"), F.count_if(inside).alias("in_window"))


def tri_state(column: str, prefix: str) -> list[Column]:
    """Counts of true, false and missing."""
    c = F.col(column)
    return [F.count_if(c).alias(f"{prefix}_true"), F.count_if(~c).alias(f"{prefix}_false"), F.count_if(c.isNull()).alias(f"{prefix}_missing")]


def state_histogram(df: DataFrame, column: str) -> DataFrame:
    """(state, n) with the states True, False and None as text."""
    return df.groupBy(F.coalesce(F.initcap(F.col(column).cast("string")), F.lit("None")).alias("state")).agg(F.count("*").alias("n"))


def date_semantics(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """First and last date, and how many rows lie inside, outside, or have none."""
    inside = F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"), F.count_if(inside).alias("inside"), F.count_if(~inside).alias("outside"), F.count_if(F.col(column).isNull()).alias("missing"))


def most_common(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """(value, n) of the n commonest values, ties by value."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("value")).limit(n)
