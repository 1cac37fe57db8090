"""Error counts over all staging rows, valid or not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDITED = ("transaction_id", "customer_id", "transaction_date", "quantity", "price", "tax")


def has_error() -> Column:
    """A missing product id or name is no error."""
    broken = F.lit(False)
    for name in AUDITED:
        broken = broken | F.col(name).isNull()
    return broken


def _counts(reported: Sequence[str]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in reported],
        F.count_if(has_error()).alias("total_rows_with_errors"),
    ]


def errors_by_customer(staged: DataFrame) -> DataFrame:
    """Rows without customer share the text key 'NULL'."""
    reported = [name for name in AUDITED if name != "customer_id"]
    return (
        staged.groupBy("customer_id")
        .agg(*_counts(reported))
        .withColumn("customer_id", F.coalesce(F.col("customer_id").cast("string"), F.lit("NULL")))
    )


def errors_by_load_date(staged: DataFrame) -> DataFrame:
    return staged.groupBy(F.col("loaded_at").cast("date").alias("load_date")).agg(
        *_counts(AUDITED)
    )
