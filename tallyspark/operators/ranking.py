"""Ordered views of the marts. NULLs are last ascending and first descending."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The order in which each mart is shown.
MART_ORDER = {
    "agg_by_customer": ["customer_id"],
    "agg_by_product": ["product_id"],
    "agg_by_customer_product": ["customer_id", "product_id"],
    "audit_errors_by_customer": ["-total_rows_with_errors", "customer_id"],
    "audit_errors_by_load_date": ["load_date"],
}


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sort by columns; a leading minus means descending."""
    return df.orderBy(
        *[
            F.col(c[1:]).desc_nulls_first() if c.startswith("-") else F.col(c).asc_nulls_last()
            for c in columns
        ]
    )


def sorted_mart(name: str, mart: DataFrame) -> DataFrame:
    return in_order(mart, MART_ORDER[name])


def ranked(mart: DataFrame, measure: str, key: Sequence[str]) -> DataFrame:
    """Full ranking, largest first; missing measures last; ties by key."""
    ties = [F.col(c).asc_nulls_last() for c in key]
    return mart.select(*key, measure).orderBy(F.col(measure).desc_nulls_last(), *ties)


def top(
    mart: DataFrame, measure: str, key: Sequence[str], shown: Sequence[str], n: int = 3
) -> DataFrame:
    """The n rows with the largest measure; ties by key."""
    ties = [F.col(c).asc_nulls_last() for c in key]
    return mart.orderBy(F.col(measure).desc_nulls_last(), *ties).limit(n).select(*shown)


def preview(fact: DataFrame, n: int = 5) -> DataFrame:
    """First rows in key order; the other columns settle repeated ids."""
    key = ["transaction_id", "customer_id", "transaction_date", "product_id", "total_amount"]
    return fact.orderBy(*[F.col(c).asc_nulls_last() for c in key]).limit(n)
