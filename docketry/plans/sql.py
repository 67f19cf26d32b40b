"""The SQL surface: views over the layers, and the seven levels of questions as SQL text.

The view `judgments` has `year` as text, as the published table declares it, and both `court` (code in paths) and
`court_name`. Equality filters on year, court and bench are better passed to register(), which then reads only
those leaves; SQL filters on other columns are pushed to the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions.courts import court_dimension
from docketry.sources.readers import index_files, read_benches, read_indexes, read_judgments


def register(spark: SparkSession, root: str, benches_csv: str | None = None, indexes: str | None = None, years: list[int] | None = None, courts: list[str] | None = None) -> None:
    """Temp views: judgments, court_dim, and where paths are given bench_dim, tar_parts and tar_files."""
    read_judgments(spark, root, years, courts).withColumn("year", F.col("year").cast("string")).createOrReplaceTempView("judgments")
    court_dimension(spark).createOrReplaceTempView("court_dim")
    if benches_csv:
        read_benches(spark, benches_csv).createOrReplaceTempView("bench_dim")
    if indexes:
        both = read_indexes(spark, indexes, "data").unionByName(read_indexes(spark, indexes, "metadata"))
        both.selectExpr("data_type", "year", "court", "bench", "inline(parts)").createOrReplaceTempView("tar_parts")
        index_files(both).createOrReplaceTempView("tar_files")


#: Level -> SQL with named parameters. Ties of a LIMIT are settled by the key, so results repeat.
LEVELS = {
    "selection": "SELECT court_code, title, judge, date_of_registration, decision_date, court_name, year, court FROM judgments WHERE year = :year AND court = :court ORDER BY pdf_link LIMIT 10",
    "newest": "SELECT title, decision_date, court_name FROM judgments WHERE year = :year ORDER BY decision_date DESC NULLS LAST, pdf_link LIMIT 10",
    "pattern": "SELECT title, judge, decision_date FROM judgments WHERE title LIKE concat('%', :word, '%')",
    "judge_pattern": "SELECT title, judge, court_name FROM judgments WHERE judge LIKE concat('%', :word, '%') AND year = :year ORDER BY pdf_link LIMIT 10",
    "top_judges": "SELECT judge, count(*) AS case_count FROM judgments WHERE year = :year GROUP BY judge ORDER BY case_count DESC, judge LIMIT 5",
    "busy_judges": "SELECT judge, count(*) AS case_count FROM judgments GROUP BY judge HAVING count(*) > :least ORDER BY case_count DESC, judge",
    "busy_courts": "SELECT court_name, count(*) AS total_judgments FROM judgments WHERE year = :year GROUP BY court_name HAVING count(*) > :least ORDER BY total_judgments DESC, court_name",
    "cases_of_judges_of": "SELECT title, judge, court_name FROM judgments WHERE judge IN (SELECT judge FROM judgments WHERE court = :court GROUP BY judge HAVING count(*) > :least) AND year = :year",
    "cases_of_busy_judges": "SELECT title, judge, decision_date FROM judgments WHERE judge IN (SELECT judge FROM judgments GROUP BY judge HAVING count(*) > :least)",
    "ranked": "SELECT title, court_name, decision_date, rank() OVER (PARTITION BY court_name ORDER BY decision_date DESC NULLS LAST) AS date_rank FROM judgments WHERE year = :year",
}


def ask(spark: SparkSession, level: str, **parameters) -> DataFrame:
    """One of LEVELS over the registered views."""
    return spark.sql(LEVELS[level], args=parameters)


def case_links(sides: dict[str, DataFrame], numbers: list[str]) -> DataFrame:
    """(cnr, side, links): what each side (cnr, pdf_link, decision_date) holds of the given case numbers."""
    out = None
    for name, df in sides.items():
        found = df.where(F.col("cnr").isin(numbers)).groupBy("cnr").agg(F.array_sort(F.collect_list(F.struct("decision_date", "pdf_link"))).alias("links"))
        found = found.select("cnr", F.lit(name).alias("side"), "links")
        out = found if out is None else out.unionByName(found)
    return out
