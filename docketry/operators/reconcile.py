"""Reconciliation of portal totals with the layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAYERS = ("metadata_json_objects", "data_pdf_objects", "metadata_index_file_count", "data_index_file_count", "parquet_rows")


def against_baseline(baseline: DataFrame, audit: DataFrame, layers: list[str], keys: tuple[str, ...] = ("court", "year"), total: str = "portal_total", zero_fill: bool = True) -> DataFrame:
    """baseline with each layer's count and `<layer>_delta` = total - count.

    Keys of the audit alone are dropped. A missing layer is 0; with zero_fill off, a missing layer or total
    makes the delta null.
    """
    j = baseline.join(audit.select(*keys, *layers), list(keys), "left")
    if zero_fill:
        j = j.na.fill(0, [*layers, total])
    return j.withColumns({f"{x}_delta": F.col(total) - F.col(x) for x in layers})


def summary(compared: DataFrame, measures: list[str], differences: list[tuple[str, str]]) -> DataFrame:
    """Sums of the measures, and the differences of pairs of sums as `<a>_minus_<b>`."""
    sums = compared.agg(*(F.sum(m).alias(m) for m in measures))
    return sums.withColumns({f"{a}_minus_{b}": F.col(a) - F.col(b) for a, b in differences})


def top_gaps(compared: DataFrame, gap: str, n: int = 30, keys: tuple[str, ...] = ("court", "year")) -> DataFrame:
    """The n largest and the n smallest gaps, as `side` and `rank`; ties by keys. Two top-k plans, no global sort."""
    from pyspark.sql import Window

    def side(name: str, by: Column) -> DataFrame:
        top = compared.orderBy(by, *keys).limit(n)
        return top.withColumns({"side": F.lit(name), "rank": F.row_number().over(Window.orderBy(by, *keys))})

    return side("largest", F.desc_nulls_last(gap)).unionByName(side("smallest", F.asc_nulls_last(gap)))


def chunked_total(chunks: DataFrame, keys: list[str], count: str = "n", error: str = "error", order: str = "chunk") -> DataFrame:
    """Total per keys over date chunks: null if any chunk failed, with the first three errors joined by `;`."""
    errors = F.array_sort(F.collect_list(F.when(F.col(error).isNotNull(), F.struct(F.col(order).alias("o"), F.col(error).alias("e")))))
    total = F.when(F.count_if(F.col(error).isNotNull()) == 0, F.sum(count))
    return chunks.groupBy(*keys).agg(total.alias("total"), F.array_join(F.transform(F.slice(errors, 1, 3), lambda x: x["e"]), ";").alias("errors"))


def merged_measures(left: DataFrame, right: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Sums by keys over two tables that each hold some of the measures; what is missing counts as 0."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures))
