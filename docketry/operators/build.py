"""From raw records to judgments: each snippet is parsed once, row by row, with no combine step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry import schemas
from docketry.functions import scalars as S
from docketry.functions.html import html_fields


def parse_records(raw: DataFrame) -> DataFrame:
    """raw with `f` (the snippet's fields), `decision_date`, `strict_year` and `drop_reason` (null for good rows)."""
    rows = raw.withColumn("f", html_fields(F.coalesce("raw_html", F.lit(""))))
    reason = (
        F.when(F.col("raw_html").isNull(), "without_html")
        .when(F.col("court_code").isNull() | F.col("pdf_link").isNull(), "missing_field")
        .when(~F.col("f.judge_valid"), "bad_judge")
    )
    return rows.withColumns({"decision_date": S.lenient_date(F.col("f.decision_date")), "strict_year": F.year(S.strict_date(F.col("f.decision_date"))), "drop_reason": reason})


def build_judgments(raw: DataFrame, pdf_names: DataFrame | None = None) -> DataFrame:
    """Judgment rows with partition columns, of the records that have all they need and a strict date's year.

    pdf_names (a column `name`) says which PDFs exist; without it pdf_exists is null.
    """
    rows = parse_records(raw).where("drop_reason is null and strict_year is not null")
    path = F.col("path") if "path" in raw.columns else F.lit(None).cast("string")
    rows = rows.select(
        "court_code", "f.title", "f.description", "f.judge", "pdf_link", "f.cnr", "f.date_of_registration", "decision_date", "f.disposal_nature",
        "f.court_name", "raw_html", F.col("strict_year").alias("year"), S.to_path_code(F.col("court_code")).alias("court"),
        F.coalesce(S.staged_bench(path), S.staged_bench(F.col("pdf_link")), S.path_part(path, "bench")).alias("bench"),
    )
    if pdf_names is None:
        return rows.withColumn("pdf_exists", F.lit(None).cast("boolean")).select(*schemas.JUDGMENT_COLUMNS, *schemas.PARTITIONS)
    names = pdf_names.select(F.col("name").alias("_pdf")).distinct().withColumn("_there", F.lit(True))
    joined = rows.join(names, S.basename(F.col("pdf_link")) == F.col("_pdf"), "left")
    return joined.withColumn("pdf_exists", F.coalesce("_there", F.lit(False))).select(*schemas.JUDGMENT_COLUMNS, *schemas.PARTITIONS)


def build_counts(raw: DataFrame) -> DataFrame:
    """How many records were used, and how many were dropped for which reason."""
    p = parse_records(raw)
    return p.agg(
        F.count("*").alias("records"),
        F.count_if(F.col("drop_reason").isNull()).alias("parsed"),
        F.count_if(F.col("drop_reason") == "without_html").alias("without_html"),
        F.count_if(F.col("drop_reason") == "missing_field").alias("missing_field"),
        F.count_if(F.col("drop_reason") == "bad_judge").alias("bad_judge"),
        F.count_if(F.col("drop_reason").isNull() & F.col("strict_year").isNull()).alias("without_year"),
    )


def quarantine(raw: DataFrame) -> DataFrame:
    """Records whose court code or link is not of the valid form, with the reason."""
    reason = F.when(~S.valid_court_code(F.col("court_code")), "court_code").when(~S.valid_pdf_link(F.col("pdf_link")), "pdf_link")
    return raw.withColumn("reason", reason).where("reason is not null")


def outcome(has_button, json_in_s3, pdf_in_s3, pdf_local, downloaded):
    """Class of a search row; the first that applies."""
    return (
        F.when(~has_button, "parse_failure")
        .when(downloaded, "downloaded")
        .when(json_in_s3 & pdf_in_s3, "skip_s3")
        .when(pdf_in_s3 & ~json_in_s3, "metadata_only")
        .when(pdf_local & ~pdf_in_s3, "skip_local")
        .otherwise("no_download")
    )


def stored_flags(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """rows (name, from_date, to_date, local_year) with json_in_s3 and pdf_in_s3.

    A name is looked up in the year of its local JSON if there is one, else in the years of both ends of the
    window. stored has (layer in {json, pdf}, year, name).
    """
    years = F.when(F.col("local_year").isNotNull(), F.array("local_year")).otherwise(F.array_distinct(F.array(F.year("from_date"), F.year("to_date"))))
    keyed = rows.withColumn("_id", F.monotonically_increasing_id()).withColumn("_year", F.explode(years))
    there = stored.groupBy(F.col("year").alias("_y"), F.col("name").alias("_n")).agg(F.bool_or(F.col("layer") == "json").alias("_json"), F.bool_or(F.col("layer") == "pdf").alias("_pdf"))
    hit = keyed.join(there, (F.col("_year") == F.col("_y")) & (F.col("name") == F.col("_n")), "left")
    flags = hit.groupBy("_id", *rows.columns).agg(F.bool_or(F.coalesce("_json", F.lit(False))).alias("json_in_s3"), F.bool_or(F.coalesce("_pdf", F.lit(False))).alias("pdf_in_s3"))
    return flags.drop("_id")


def pair_files(files: DataFrame) -> DataFrame:
    """JSON files with the PDF of the same folder and stem; (stem, folder, year, json, pdf). The PDF takes the JSON's year.

    files has path and, for JSON, year (null if its date is not strict; such pairs have a null year).
    """
    keyed = files.withColumns({"stem": S.stem(F.col("path")), "folder": S.dirname(F.col("path")), "kind": F.lower(F.regexp_extract("path", r"\.([^.]+)$", 1))})
    return keyed.where(F.col("kind").isin("json", "pdf")).groupBy("folder", "stem").agg(
        F.max(F.when(F.col("kind") == "json", F.col("year"))).alias("year"),
        F.max(F.when(F.col("kind") == "json", F.col("path"))).alias("json"),
        F.max(F.when(F.col("kind") == "pdf", F.col("path"))).alias("pdf"),
    )


def grouped_files(pairs: DataFrame) -> DataFrame:
    """(year, bench, files ascending, n) of the pairs with a year."""
    bench = S.staged_bench(F.coalesce("json", "pdf"))
    one = pairs.where("year is not null").withColumn("bench", bench).withColumn("file", F.explode(F.array_compact(F.array("json", "pdf"))))
    return one.groupBy("year", "bench").agg(F.array_sort(F.collect_list("file")).alias("files"), F.count("*").alias("n"))
