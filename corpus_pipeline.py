"""A training corpus in five stages, each a DataFrame that is written and read again before the next.

    language -> near_duplicates -> decontamination -> mixing -> token_ids

Every stage judges rows by their texts: rows without an id, and rows that repeat an id, are judged as all others, and
columns beside doc_id, text, lang and source go through unread, whatever their names. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketry.llm.decontaminate import clean_documents
from docketry.llm.language_id import UNKNOWN, fit_languages, identify, remainder
from docketry.llm.mixing import mixed_documents
from docketry.llm.ngram_join import jaccard_components
from docketry.llm.shared import free_name, stored
from docketry.llm.token_files import token_report

#: Documents whose language is not clear go: `und`, or a score below this.
LEAST_LANGUAGE_SCORE = 0.4
#: Near duplicates: words of a shingle, and the least similarity in percent.
N_WORDS, PERCENT = 5, 80
#: Parts that documents of this similarity have alike on average, at the least (see README for what that may miss).
EQUAL_PARTS = 8.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null, empty and letterless texts go."""
    model = fit_languages(docs, remainder("doc_id", 4) != 2)
    lang, score = free_name(docs, "language"), free_name(docs, "language_score")
    judged = identify(docs, model, keep=docs.columns, names=(lang, score))
    return judged.where((F.col(lang) != UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that link by N_WORDS-word shingles (PERCENT of similarity), the one with the smallest id.

    A row without an id has a hash of its text for one, so it links as others do. Of rows that repeat an id and a
    text one stays, the first by a hash of its other columns. Null and blank texts link with nothing.
    """
    key, text, rest, rank = (free_name(docs, x) for x in ("key", "text_hash", "rest", "rank"))
    own = F.coalesce("doc_id", F.xxhash64("text", F.lit("no id")))
    groups = jaccard_components(docs.select(own.alias("id"), "text"), "id", "text", N_WORDS, PERCENT, text_hash=True, equal_parts=EQUAL_PARTS)
    kept = groups.where("id = component_id").select(F.col("id").alias(key), F.col("text_hash").alias(text)).distinct()
    rows = docs.withColumns({key: own, text: F.xxhash64("text")}).join(kept.hint("merge"), [key, text], "left_semi")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = rows.withColumn(rest, F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0).cast("long"))
    # Dealt by these keys already, so this sorts and does not shuffle.
    one = Window.partitionBy(key, text).orderBy(rest)
    return rows.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth occurs in benchmark items; each row is judged by its own text."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes most of them: not at all, once or twice.

    A null source is a source of its own; texts without words are never taken; repeated rows share what is taken.
    """
    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; a line per document, in the order of ids (rows without one come first)."""
    return token_report(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each but the last returns is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language prediction and tokenization cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None
