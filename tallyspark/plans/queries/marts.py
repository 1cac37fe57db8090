"""Fact, customer dimension, aggregate marts, audits, and their orderings.

Array columns are shown as text, so that both engines hash the same value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.arrays import as_text, sorted_with_null_last
from tallyspark.operators import audit, marts, ranking
from tallyspark.plans.queries.base import fact, mean_cents, query, staged


def by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.agg_by_customer(fact(spark, sf_dir))


def by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.agg_by_product(fact(spark, sf_dir))


def by_customer_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.agg_by_customer_product(fact(spark, sf_dir))


query("fact_transactions", "SELECT * FROM {fact}")(fact)


@query("dim_customers", "SELECT * FROM {dim_customers}")
def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_customers(staged(spark, sf_dir))


@query("agg_by_customer", "SELECT * FROM {agg_by_customer}")
def agg_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_customer(spark, sf_dir).withColumn("product_ids", as_text(F.col("product_ids")))


@query("agg_by_product", "SELECT * FROM {agg_by_product}")
def agg_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_product(spark, sf_dir).withColumn("customer_ids", as_text(F.col("customer_ids")))


query("agg_by_customer_product", "SELECT * FROM {agg_by_customer_product}")(by_customer_product)


@query("audit_errors_by_customer", "SELECT * FROM {errors_by_customer}")
def errors_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.errors_by_customer(staged(spark, sf_dir))


@query("audit_errors_by_load_date", "SELECT * FROM {errors_by_load_date}")
def errors_by_load_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.errors_by_load_date(staged(spark, sf_dir))


# --- row-level measures -------------------------------------------------------

_MEASURES = {
    "measure_gross_amount": ("gross_amount", marts.gross_amount),
    "measure_total_amount": ("total_amount", marts.total_amount),
    "measure_tax_rate_pct": ("tax_rate_pct", marts.tax_rate_pct),
}
for _name, (_column, _expression) in _MEASURES.items():
    query(_name, f"SELECT quantity, unit_price AS price, tax, {_column} FROM {{fact}}")(
        lambda spark, sf_dir, column=_column, expression=_expression: marts.measured_rows(
            staged(spark, sf_dir)
        ).select("quantity", "price", "tax", expression().alias(column))
    )


# --- one aggregate function each ----------------------------------------------


@query(
    "agg_count_star",
    "SELECT product_name, count(*) AS row_count FROM {staged} GROUP BY product_name",
)
def count_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir).groupBy("product_name").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "agg_count_distinct",
    """SELECT customer_id, count(DISTINCT product_id) AS products FROM {fact}
       GROUP BY customer_id""",
)
def count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        fact(spark, sf_dir)
        .groupBy("customer_id")
        .agg(F.count_distinct("product_id").alias("products"))
    )


@query(
    "agg_count_filter",
    """SELECT product_name, count(*) FILTER (price IS NULL) AS null_price,
       count(*) FILTER (tax IS NULL) AS null_tax FROM {staged} GROUP BY product_name""",
)
def count_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        staged(spark, sf_dir)
        .groupBy("product_name")
        .agg(
            F.count_if(F.col("price").isNull()).alias("null_price"),
            F.count_if(F.col("tax").isNull()).alias("null_tax"),
        )
    )


@query(
    "agg_min_max_date",
    """SELECT product_id, min(transaction_date) AS first_date, max(transaction_date) AS last_date
       FROM {fact} GROUP BY product_id""",
)
def min_max_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        fact(spark, sf_dir)
        .groupBy("product_id")
        .agg(
            F.min("transaction_date").alias("first_date"),
            F.max("transaction_date").alias("last_date"),
        )
    )


@query(
    "agg_sum_int",
    "SELECT customer_id, CAST(sum(quantity) AS BIGINT) AS units FROM {fact} GROUP BY customer_id",
)
def sum_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir).groupBy("customer_id").agg(F.sum("quantity").alias("units"))


@query(
    "agg_sum_decimal_round",
    """SELECT product_id, CAST(round(sum(tax), 2) AS DECIMAL(38,2)) AS taxes FROM {fact}
       GROUP BY product_id""",
)
def sum_decimal_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    taxes = F.round(F.sum("tax"), 2).cast("decimal(38,2)")
    return fact(spark, sf_dir).groupBy("product_id").agg(taxes.alias("taxes"))


@query(
    "agg_avg_decimal_round",
    f"""SELECT customer_id, {mean_cents("unit_price")} AS avg_price
        FROM {{fact}} GROUP BY customer_id""",
)
def avg_decimal_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    average = marts.mean_amount("unit_price")
    return fact(spark, sf_dir).groupBy("customer_id").agg(average.alias("avg_price"))


@query(
    "agg_sorted_distinct_array",
    """SELECT customer_id, array_to_string(
           list_transform(list_sort(list(DISTINCT product_id) FILTER (product_id IS NOT NULL)),
                          lambda x: CAST(x AS VARCHAR))
           || CASE WHEN count(*) FILTER (product_id IS NULL) > 0 THEN ['NULL'] ELSE [] END, ',')
           AS product_ids
       FROM {fact} GROUP BY customer_id""",
)
def sorted_distinct_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs are made distinct first, spread over all tasks, and then gathered."""
    pairs = fact(spark, sf_dir).select("customer_id", "product_id").distinct()
    ids = sorted_with_null_last(
        F.collect_list("product_id"), F.count_if(F.col("product_id").isNull()) > 0
    )
    return pairs.groupBy("customer_id").agg(as_text(ids).alias("product_ids"))


# --- sort, rank, top ----------------------------------------------------------


@query("sort_marts", "SELECT * FROM {agg_by_customer_product} ORDER BY customer_id, product_id")
def sort_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.sorted_mart("agg_by_customer_product", by_customer_product(spark, sf_dir))


@query("sort_agg_by_customer", "SELECT * FROM {agg_by_customer} ORDER BY customer_id")
def sort_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.sorted_mart("agg_by_customer", agg_by_customer(spark, sf_dir))


@query("sort_agg_by_product", "SELECT * FROM {agg_by_product} ORDER BY product_id NULLS LAST")
def sort_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.sorted_mart("agg_by_product", agg_by_product(spark, sf_dir))


@query(
    "sort_audit_by_customer",
    "SELECT * FROM {errors_by_customer} ORDER BY total_rows_with_errors DESC, customer_id",
)
def sort_audit_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.sorted_mart("audit_errors_by_customer", errors_by_customer(spark, sf_dir))


@query("sort_audit_by_load_date", "SELECT * FROM {errors_by_load_date} ORDER BY load_date")
def sort_audit_by_load_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.sorted_mart("audit_errors_by_load_date", errors_by_load_date(spark, sf_dir))


@query(
    "rank_customers_by_revenue",
    """SELECT customer_id, total_paid FROM {agg_by_customer}
       ORDER BY total_paid DESC, customer_id""",
)
def customers_by_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(by_customer(spark, sf_dir), "total_paid", ["customer_id"])


@query(
    "rank_customers_by_transactions",
    """SELECT customer_id, total_transactions FROM {agg_by_customer}
       ORDER BY total_transactions DESC, customer_id""",
)
def customers_by_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(by_customer(spark, sf_dir), "total_transactions", ["customer_id"])


@query(
    "rank_products_by_revenue",
    """SELECT product_name, product_id, total_paid FROM {agg_by_product}
       ORDER BY total_paid DESC, product_name NULLS LAST, product_id NULLS LAST""",
)
def products_by_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(by_product(spark, sf_dir), "total_paid", ["product_name", "product_id"])


@query(
    "rank_products_by_units",
    """SELECT product_name, product_id, total_products FROM {agg_by_product}
       ORDER BY total_products DESC, product_name NULLS LAST, product_id NULLS LAST""",
)
def products_by_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(
        by_product(spark, sf_dir), "total_products", ["product_name", "product_id"]
    )


@query(
    "top3_customers_by_revenue",
    """SELECT customer_id, total_paid, total_transactions FROM {agg_by_customer}
       ORDER BY total_paid DESC, customer_id LIMIT 3""",
)
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = ["customer_id", "total_paid", "total_transactions"]
    return ranking.top(by_customer(spark, sf_dir), "total_paid", ["customer_id"], shown)


@query(
    "top3_products_by_revenue",
    """SELECT product_name, total_paid, total_products FROM {agg_by_product}
       ORDER BY total_paid DESC, product_name, product_id NULLS LAST LIMIT 3""",
)
def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top(
        by_product(spark, sf_dir),
        "total_paid",
        ["product_name", "product_id"],
        ["product_name", "total_paid", "total_products"],
    )


@query(
    "preview_head",
    """SELECT * FROM {fact} ORDER BY transaction_id, customer_id, transaction_date,
       product_id NULLS LAST, total_amount LIMIT 5""",
)
def preview_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.preview(fact(spark, sf_dir))
