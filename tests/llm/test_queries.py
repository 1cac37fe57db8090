"""Registered queries against their SQL, and the pipeline stage by stage."""

import os

import compare
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tallyspark.llm import packing
from tallyspark.llm.common import table
from tallyspark.llm.queries import ORACLE_SQL, QUERIES
from tallyspark.session import materialize

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")

TABLES = {"op3_warc": ["pages"], "op8_embedding_dedup": ["embeddings"], "op2_language_id": ["documents", "pages"]}

# Queries with another number of rows than their tables, and how many there are.
ROWS = {
    "op5_packing": lambda spark: packing.pieces_of(table(spark, SF_DIR, "documents")).count(),
    "op11_hashed_search": lambda spark: 20 * table(spark, SF_DIR, "embeddings").where("vec_id % 20 = 0").count(),
    "op12_spelling_variants": lambda spark: compare.connect(SF_DIR).sql(ORACLE_SQL["op12_spelling_variants"]).count("*").limit(1).fetchall()[0][0],
}


def test_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    columns, rows = compare.spark_rows(QUERIES[name](spark, SF_DIR))
    if name in ROWS:
        assert len(rows) == ROWS[name](spark)
    else:
        assert len(rows) == sum(table(spark, SF_DIR, t).count() for t in TABLES.get(name, ["documents"]))
    if name in ORACLE_SQL:
        assert (columns, rows) == compare.sql_rows(compare.connect(SF_DIR), ORACLE_SQL[name])


def test_pipeline(spark):
    docs = table(spark, SF_DIR, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF_DIR), f"test-{name}")
        assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        assert 0 < docs.count() <= before
        before = docs.count()
    assert docs.where("text RLIKE '[A-Za-z0-9]@[a-z0-9]+[.]'").isEmpty()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert packed.select("doc_id").distinct().count() == before
