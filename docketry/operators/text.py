"""Text of documents as arrays of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions import scalars as S


def pages_of(text: Column, separator: str = "\f") -> Column:
    """Pages of extracted text, stripped, without the blank ones."""
    return F.filter(F.transform(F.split(text, separator), S.strip), lambda p: p != "")


def pages_table(docs: DataFrame, text: str, separator: str = "\f") -> DataFrame:
    """docs with `pages` (array) and `pages_json` (the array as valid JSON) in place of the text."""
    pages = pages_of(F.col(text), separator)
    return docs.withColumn("pages", pages).withColumn("pages_json", S.pages_text(F.col("pages"))).drop(text)
