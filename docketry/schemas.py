"""Schemas of the layers: raw records, judgments, tar indexes, listings, dimensions, audit output."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_RECORD = "court_code string, court_name string, raw_html string, pdf_link string, downloaded boolean"

#: The query layer, in its fixed column order; the court's name is `court_name`, since `court` is a partition.
JUDGMENT = (
    "court_code string, title string, description string, judge string, pdf_link string, cnr string, "
    "date_of_registration string, decision_date date, disposal_nature string, court_name string, raw_html string, pdf_exists boolean"
)
JUDGMENT_COLUMNS = [x.split()[0] for x in JUDGMENT.split(", ")]
PARTITIONS = ["year", "court", "bench"]

#: Optional properties of the PDF behind a row.
PDF_PROPERTIES = (
    "pdf_size_bytes long, pdf_page_count long, pdf_version double, pdf_linearized boolean, "
    "pdf_title string, pdf_author string, pdf_creator string, pdf_producer string"
)

_PART = "name string, files array<string>, file_count long, size long, size_human string, created_at string"
#: Index of tar parts; older indexes have `files` at the top and no parts.
TAR_INDEX = f"file_count long, tar_size long, tar_size_human string, updated_at string, scraped_through_date string, files array<string>, created_at string, parts array<struct<{_PART.replace(' string', ':string').replace(' array', ':array').replace(' long', ':long')}>>"

LISTING = "data_type string, layer string, year int, court string, bench string, name string, size long, mtime timestamp"
PORTAL_BASELINE = "court string, court_name string, year int, portal_total long"
LAYER_AUDIT = "court string, year int, metadata_json_objects long, data_pdf_objects long, metadata_index_file_count long, data_index_file_count long, parquet_rows long"
UPLOAD_RESULT = "court string, bench string, year int, uploaded long, skipped long, bytes long, status string"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
