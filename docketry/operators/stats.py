"""Rollups over index records, and the published size page."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.functions import scalars as S
from docketry.session import small


def rollups(records: DataFrame) -> DataFrame:
    """Rollups by year, court, bench, and in total, from one pass over grouping sets.

    records: data_type, year, court, bench, files, size. Columns: level, year, court, bench, and for data and
    metadata files and size; distinct courts, benches and years, the last two also as ascending arrays.
    """
    levels = F.when(F.grouping("year") == 0, "year").when(F.grouping("court") == 0, "court").when(F.grouping("bench") == 0, "bench").otherwise("total")
    measures = [F.coalesce(F.sum(F.when(F.col("data_type") == t, F.col(m))), F.lit(0)).alias(f"{t}_{m}") for t in ("data", "metadata") for m in ("files", "size")]
    rows = records.withColumns({"_y": F.col("year"), "_c": F.col("court"), "_b": F.col("bench")})
    g = rows.groupingSets([[F.col("year")], [F.col("court")], [F.col("bench")], []], F.col("year"), F.col("court"), F.col("bench"))
    return g.agg(levels.alias("level"), *measures, F.countDistinct("_c").alias("courts"), F.countDistinct("_b").alias("n_benches"), F.countDistinct("_y").alias("n_years"), F.array_sort(F.collect_set("_y")).alias("years"), F.array_sort(F.collect_set("_b")).alias("benches"))


def with_names(df: DataFrame, dimension: DataFrame, code: str, dim_code: str, dim_name: str, name: str, default: str | None = None) -> DataFrame:
    """df with the name of its code, in either spelling of codes; unknown codes keep themselves or get the default."""
    # Dimensions have tens of rows (25 courts, 45 benches); one that has more is not broadcast.
    d = small(dimension.select(S.to_path_code(F.col(dim_code)).alias("_code"), F.col(dim_name).alias("_name")).dropDuplicates(["_code"]))
    missing = F.col(code) if default is None else F.lit(default)
    return df.join(d, S.to_path_code(F.col(code)) == F.col("_code"), "left").withColumn(name, F.coalesce("_name", missing)).drop("_code", "_name")


def merged_dimension(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Rows of first, and those of second whose key first lacks."""
    return first.unionByName(second.join(first.select(key), key, "left_anti"))


def arg_max(df: DataFrame, group: str, measure: str) -> DataFrame:
    """The group with the highest sum of the measure; ties go to the smallest group."""
    sums = df.groupBy(group).agg(F.sum(measure).alias(measure))
    return sums.orderBy(F.desc_nulls_last(measure), F.asc_nulls_last(group)).limit(1)


def top_with_rank(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    order = [F.desc_nulls_last(by), F.asc_nulls_last(tie)]
    return df.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def year_range(df: DataFrame, year: str, measures: list[str]) -> DataFrame:
    """First and last year with any measure above 0."""
    some = F.lit(False)
    for m in measures:
        some = some | (F.coalesce(m, F.lit(0)) > 0)
    return df.where(some).agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"))


def combinations(years: DataFrame, courts: DataFrame, benches: DataFrame) -> DataFrame:
    """year x court x bench, the benches joined to their court: each pair is repeated for the years, which are few."""
    listed = years.select("year").distinct().agg(F.array_sort(F.collect_set("year")).alias("years"))
    pairs = courts.join(small(benches), "court")
    # One row, whatever the size of the dimensions.
    return pairs.join(F.broadcast(listed)).select(F.explode("years").alias("year"), *pairs.columns)


def compression_summary(df: DataFrame, keys: list[str], before: str = "original", after: str = "compressed") -> DataFrame:
    """Bytes before and after, and the share saved in percent (0 where nothing was there)."""
    sums = df.groupBy(*keys).agg(F.sum(before).alias(before), F.sum(after).alias(after))
    return sums.withColumn("saved_percent", F.coalesce(F.try_divide((F.col(before) - F.col(after)) * 100.0, F.col(before)), F.lit(0.0)))


def tar_sizes(listing: DataFrame) -> DataFrame:
    """Bytes of tar objects by court and year; index files do not count."""
    tars = listing.where(~F.col("name").endswith(".index.json") & (F.col("name").endswith(".tar") | F.col("name").endswith(".tar.gz")))
    return tars.groupBy("court", "year").agg(F.sum("size").alias("size"))


def court_benches(listing: DataFrame) -> DataFrame:
    """One row: distinct courts, and distinct pairs of court and bench (a bench of the same name in two courts is two)."""
    return listing.agg(F.countDistinct("court").alias("courts"), F.countDistinct(F.struct("court", "bench")).alias("benches"))


def filtered(records: DataFrame, years: list[int] | None = None, courts: list[str] | None = None) -> DataFrame:
    """Records of the given years and courts (codes in either spelling); an empty or missing list is no filter."""
    if years:
        records = records.where(F.col("year").isin(years))
    if courts:
        records = records.where(S.to_path_code(F.col("court")).isin([c.replace("~", "_") for c in courts]))
    return records


def listed_sizes(totals: DataFrame, least_gib: float | None = None) -> DataFrame:
    """Totals with `gib`; with least_gib without those below, else without those that have neither PDFs nor metadata."""
    some = (F.col("pdfs") > 0) | (F.col("metadata") > 0)
    rows = totals.withColumn("gib", S.gib(F.col("size")))
    return rows.where(some) if least_gib is None else rows.where((some | (F.col("size") > 0)) & (F.col("gib") >= least_gib))


def totals_by(counts: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """(key, pdfs, metadata, size) from counts (court, year, pdfs, metadata) and sizes (court, year, size)."""
    both = counts.select(key, "pdfs", "metadata").unionByName(sizes.select(key, "size"), allowMissingColumns=True)
    return both.groupBy(key).agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in ("pdfs", "metadata", "size")))


def size_page(counts: DataFrame, listing: DataFrame, snapshot: date, least_gib: float = 1.0) -> str:
    """The published page: totals, a table of courts by PDFs, a table of years above least_gib.

    The aggregates (a row per court and per year) are computed in Spark and laid out here.
    """
    sizes = tar_sizes(listing.withColumn("court", S.to_path_code(F.col("court"))))
    counts = counts.withColumn("court", S.to_path_code(F.col("court")))
    names = dict(counts.select("court", "court_name").distinct().collect())
    courts = totals_by(counts, sizes, "court").orderBy(F.desc("pdfs"), "court").collect()
    years = totals_by(counts, sizes, "year").orderBy("year").collect()
    benches = court_benches(listing).first()["benches"]
    active = [c for c in courts if c["pdfs"] or c["metadata"]]
    covered = [y for y in years if y["pdfs"] or y["metadata"] or y["size"]]

    def g(n: int) -> str:
        return f"{n / 2**30:,.2f}"

    def row(*cells) -> str:
        return "| " + " | ".join(str(c) for c in cells) + " |"

    out = ["# Dataset Size", "", f"Snapshot as of {snapshot:%B} {snapshot.day}, {snapshot.year}.", "", "## Totals", "", "| | |", "|---|---:|"]
    size = sum(c["size"] for c in courts)
    out += [row("Judgments/PDFs", f"**{sum(c['pdfs'] for c in courts):,}**"), row("Metadata records", f"**{sum(c['metadata'] for c in courts):,}**"), row("Total archive size", f"**{g(size)} GiB** ({size / 2**40:.2f} TiB)"), row("Courts", f"**{len(active)}**"), row("Benches", f"**{benches}**")]
    if covered:
        top, best = max(covered, key=lambda y: (y["pdfs"], -y["year"])), courts[0]
        out += [row("Years covered", f"**{covered[0]['year']}-{covered[-1]['year']}**"), row("Year with highest volume", f"**{top['year']}** ({g(top['size'])} GiB, {top['pdfs']:,} PDFs)")]
        out.append(row("Court with highest volume", f"**{names.get(best['court'], best['court'])}** (`{best['court'].replace('_', '~')}`, {g(best['size'])} GiB, {best['pdfs']:,} PDFs)"))
    out += ["", "## By Court", "", row("Code", "Court", "PDFs", "Metadata", "Size (GiB)"), "|---|---|---:|---:|---:|"]
    out += [row(c["court"].replace("_", "~"), names.get(c["court"], c["court"]), f"{c['pdfs']:,}", f"{c['metadata']:,}", g(c["size"])) for c in active]
    out += ["", "## By Year", "", f"Years below {least_gib:g} GiB are omitted.", "", row("Year", "PDFs", "Metadata", "Size (GiB)"), "|---:|---:|---:|---:|"]
    out += [row(y["year"], f"{y['pdfs']:,}", f"{y['metadata']:,}", g(y["size"])) for y in covered if y["size"] / 2**30 >= least_gib]
    return "\n".join([*out, ""])
