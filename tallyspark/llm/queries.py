"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import (
    embedding_dedup,
    fill_in_middle,
    fingerprints,
    hashed_search,
    jaccard_join,
    language_id,
    packing,
    pii,
    quality,
    sentencepiece_codec,
    spelling_variants,
    toxicity,
    warc,
)
from tallyspark.llm.common import table
from tallyspark.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and every page, one row each (doc_id or page_id is set)."""
    docs = table(spark, sf_dir, "documents")
    rows = language_id.of_documents(docs).unionByName(language_id.of_pages(table(spark, sf_dir, "pages")))
    return language_id.identify(rows, language_id.fit(docs))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_next(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.deduplicate(table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select(docs.doc_id.cast("long").alias("doc_id"), "text"), model).select(
        "doc_id", "held_out", "score", "predicted"
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op11_hashed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.transform(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_language_id": op2_language_id,
    "op3_warc": op3_warc,
    "op4_toxicity": op4_toxicity,
    "op5_packing": op5_packing,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_fingerprints": op7_fingerprints,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_quality": op9_quality,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_hashed_search": op11_hashed_search,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_fill_in_middle": op13_fill_in_middle,
}
