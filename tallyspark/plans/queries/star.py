"""The extended star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspark.operators import marts, star
from tallyspark.plans.queries.base import fact, query, staged
from tallyspark.session import materialize


@query("dim_products", "SELECT * FROM {dim_products}")
def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_products(fact(spark, sf_dir))


@query("dim_date", "SELECT * FROM {dim_date}")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_date(fact(spark, sf_dir))


@query(
    "fact_star",
    """SELECT transaction_id, customer_id, product_id, transaction_date AS date_id, quantity,
       unit_price, tax, gross_amount, total_amount, tax_rate_pct, loaded_at FROM {fact}""",
)
def fact_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_star(fact(spark, sf_dir))


@query(
    "star_join_slice",
    """SELECT d.month_name, d.is_weekend, p.product_name,
       CAST(year(c.first_transaction_date) AS INTEGER) AS cohort,
       count(*) AS transactions, CAST(sum(f.quantity) AS BIGINT) AS units,
       CAST(sum(f.total_amount) AS DECIMAL(38,2)) AS revenue
       FROM {fact} f
       JOIN {dim_date} d ON f.transaction_date = d.date_id
       JOIN {dim_products} p ON f.product_id = p.product_id
       JOIN {dim_customers} c ON f.customer_id = c.customer_id
       WHERE d.month = 7
       GROUP BY ALL""",
)
def star_join_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact and dimensions come from one written staging table."""
    staging = materialize(staged(spark, sf_dir), "staged")
    facts = marts.fact_transactions(staging)
    return star.star_slice(
        star.fact_star(facts),
        marts.dim_customers(staging),
        star.dim_products(facts),
        star.dim_date(facts),
        month=7,
    )
