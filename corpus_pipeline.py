"""From raw documents to packed sequences, one written stage after another.

Each stage takes the documents its predecessor kept. Language ID and quality drop the
documents they reject, the join keeps the smallest doc_id of each group of near copies,
personal data gives way to its kind in brackets, and what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import jaccard_join, language_id, packing, pii, quality
from tallyspark.llm.common import table
from tallyspark.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.fit(docs)).select(*COLUMNS)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("predicted = 1").select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs).select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    redacted = pii.redact(docs)
    return redacted.selectExpr("doc_id", "text", "lang", "source", "CAST(length(text) AS BIGINT) AS n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", keep_identified),
    ("quality", keep_good),
    ("jaccard_join", keep_one_of_each_group),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

# The classifiers and the genetic packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
