"""Product and date dimensions, the slim fact, and a slice through the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.schemas import MONEY


def dim_products(fact: DataFrame) -> DataFrame:
    """One row per product id with the name of its latest transaction.

    Names are compared per (id, name) first, by one packed number that a hash
    aggregate can hold, so the fact is not sorted; the second step sees one row
    per name.
    """
    # Days since 1970 above 32 bits of transaction id, shifted to be positive.
    recency = F.unix_date("transaction_date").cast("bigint") * 2**32 + (
        F.col("transaction_id").cast("bigint") + 2**31
    )
    names = (
        fact.where("product_id IS NOT NULL")
        .groupBy("product_id", "product_name")
        .agg(F.max(recency).alias("recency"))
    )
    latest = F.max(F.struct("recency", "product_name")).alias("latest")
    return (
        names.groupBy("product_id")
        .agg(latest)
        .select("product_id", F.col("latest.product_name").alias("product_name"))
    )


def dim_date(fact: DataFrame) -> DataFrame:
    """One row per calendar day between the first and the last transaction."""
    span = fact.agg(
        F.min("transaction_date").alias("first"), F.max("transaction_date").alias("last")
    )
    day = F.col("date_id")
    return span.select(F.explode(F.sequence("first", "last")).alias("date_id")).select(
        "date_id",
        F.day(day).alias("day"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        (F.last_day(day) == day).alias("is_month_end"),
        ((F.last_day(day) == day) & (F.month(day) % 3 == 0)).alias("is_quarter_end"),
    )


def fact_star(fact: DataFrame) -> DataFrame:
    return fact.select(
        "transaction_id",
        "customer_id",
        "product_id",
        F.col("transaction_date").alias("date_id"),
        "quantity",
        "unit_price",
        "tax",
        "gross_amount",
        "total_amount",
        "tax_rate_pct",
        "loaded_at",
    )


def star_slice(
    star: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame, month: int
) -> DataFrame:
    """Revenue of one calendar month by customer cohort, product and day type.

    The fact is added up before each join with a large dimension: per customer
    and product before it meets the customers, per product and cohort before it
    meets the products. A hot customer then joins with one row per product, a
    hot product with one per cohort. Spark broadcasts a dimension that is below
    its threshold and splits what is still uneven.
    """
    measures = ["transactions", "units", "revenue"]
    day_type = ["month_name", "is_weekend"]
    sums = [F.sum(name).alias(name) for name in measures]
    days = dates.where(F.col("month") == month).select("date_id", *day_type)
    cohorts = customers.select("customer_id", F.year("first_transaction_date").alias("cohort"))
    per_pair = (
        star.join(days, "date_id")
        .groupBy("customer_id", "product_id", *day_type)
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.sum("quantity").alias("units"),
            F.sum("total_amount").alias("revenue"),
        )
    )
    per_cohort = (
        per_pair.join(cohorts, "customer_id").groupBy("product_id", "cohort", *day_type).agg(*sums)
    )
    return (
        per_cohort.join(products, "product_id")
        .groupBy("product_name", "cohort", *day_type)
        .agg(*sums)
        .withColumn("revenue", F.col("revenue").cast(MONEY))
    )
