"""Marts and statistics brought up to date load by load; their SQL is that of the full computation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.arrays import as_text
from tallyspark.plans.incremental import IncrementalMarts
from tallyspark.plans.incremental_statistics import IncrementalStatistics
from tallyspark.plans.queries.base import landed, query
from tallyspark.plans.queries.statistics import BOXPLOT_SQL, DESCRIBE_SQL, rounded
from tallyspark.session import Scratch, scratch_path
from tallyspark.sources.tables import Warehouse

# name -> its array column, shown as text.
_ARRAYS = {
    "agg_by_customer": "product_ids",
    "agg_by_product": "customer_ids",
    "agg_by_customer_product": None,
    "dim_customers": None,
}


def _updated(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    warehouse = Warehouse(spark, scratch_path(spark, "incremental"))
    kept = IncrementalMarts(warehouse, (name,))
    _load(spark, sf_dir, warehouse, kept.update)
    mart, array = kept.table(name), _ARRAYS[name]
    return mart.withColumn(array, as_text(F.col(array))) if array else mart


def _load(spark: SparkSession, sf_dir: str, warehouse: Warehouse, update: Callable[..., None]) -> None:
    """Three loads, one of them wrong at first, and one that is emptied again."""
    with Scratch(spark) as scratch:
        rows = scratch.materialize(landed(spark, sf_dir), "landed")
        part = F.pmod(F.xxhash64("transaction_id", "customer_id", "price", "tax"), F.lit(3))
        warehouse.append_raw(rows.where(part == 0), "load-1")
        warehouse.append_raw(rows.where("quantity LIKE '2%'"), "load-2")
        update("load-1", "load-2")
        warehouse.append_raw(rows.where(part == 1), "load-2")
        warehouse.append_raw(rows.where("product_name = 'Product A'"), "load-3")
        update("load-2", "load-3")
        warehouse.append_raw(rows.where("false"), "load-3")
        warehouse.append_raw(rows.where(part == 2), "load-4")
        update("load-3", "load-4")


for _name in _ARRAYS:
    query(f"incremental_{_name}", f"SELECT * FROM {{{_name}}}")(
        lambda spark, sf_dir, name=_name: _updated(spark, sf_dir, name)
    )


def _statistics(spark: SparkSession, sf_dir: str) -> IncrementalStatistics:
    kept = IncrementalStatistics(Warehouse(spark, scratch_path(spark, "incremental")))
    _load(spark, sf_dir, kept.warehouse, kept.update)
    return kept


@query("incremental_describe_numeric", DESCRIBE_SQL)
def incremental_describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_statistics(spark, sf_dir).describe_numeric())


@query("incremental_boxplot_stats", BOXPLOT_SQL)
def incremental_boxplot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_statistics(spark, sf_dir).boxplot_stats())
