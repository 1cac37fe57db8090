"""What the physical plans must and must not contain."""

import os

import pytest

import __spark_entry__ as entry
from tallyspark.operators import audit, landing, marts
from tallyspark.operators.staging import stage_transactions
from tallyspark.plans.queries import base

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The landed raw layer as files."""
    path = str(tmp_path_factory.mktemp("raw") / "raw")
    base.landed(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


def test_first_wins_limits_before_the_shuffle(spark):
    text = plan(landing.first_wins(base.raw(spark, SF_DIR), ["row_seq"]))
    assert "1, Partial" in text and "1, Final" in text
    window = text[: text.index("1, Partial")]
    assert window.count("Exchange hashpartitioning") == 1


def test_anti_join_reuses_the_partitioning_of_the_window(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = base.raw(spark, SF_DIR).where("l_linenumber = 1")
        batch = base.raw(spark, SF_DIR)
        text = plan(landing.land_batch(batch, target, ["row_seq"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    anti = text.index("LeftAnti")
    # Between the join and the window of its left side there is no exchange.
    assert "Exchange" not in text[anti : text.index("Window ", anti)]


def test_the_stored_side_is_cut_before_it_is_shuffled(spark, stored):
    """Without broadcasts of Spark's own choice: a map of the batch's ids cuts the stored ids."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = base.raw(spark, SF_DIR).where("l_linenumber = 1")
        text = plan(landing.land_batch(batch, stored, ["row_seq"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The right side of the anti join: the stored ids meet the map before any exchange.
    right = text[text.index("LeftAnti") :].split("\n      +- ", 1)[1]
    scan = right[: right.index("/raw")]
    joins = [k for k in range(len(scan)) if scan.startswith("BroadcastHashJoin", k)]
    assert joins and "Exchange hashpartitioning" not in scan[joins[-1] :].split("BroadcastExchange")[0]


def test_staging_is_one_narrow_step(stored):
    text = plan(stage_transactions(stored))
    assert "Exchange" not in text


def test_scans_read_needed_columns_only(stored):
    staged = stage_transactions(stored)
    text = plan(audit.errors_by_load_date(staged))
    schema = text[text.index("ReadSchema") :]
    assert "product" not in schema
    text = plan(marts.dim_customers(staged))
    schema = text[text.index("ReadSchema") :]
    assert "product_name" not in schema and "loaded_at" not in schema


def test_filters_reach_the_scan(stored):
    text = plan(marts.fact_transactions(stage_transactions(stored)))
    pushed = text[text.index("PushedFilters") :]
    assert "IsNotNull(customer_id)" in pushed


def test_marts_scan_the_fact_once(stored):
    fact = marts.fact_transactions(stage_transactions(stored))
    for mart in (marts.agg_by_customer, marts.agg_by_product, marts.agg_by_customer_product):
        text = plan(mart(fact))
        assert text.count("FileScan") == 1
        assert text.count("Exchange") == 2


def test_top_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["top3_customers_by_revenue"](spark, SF_DIR))
