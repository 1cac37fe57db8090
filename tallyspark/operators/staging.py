"""Raw text rows to typed rows: one narrow projection, no row dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import cleaners as clean

IDENTIFYING = ("transaction_id", "customer_id", "transaction_date")


def cleaned_columns(mode: str = clean.LENIENT) -> dict[str, Column]:
    """The cleaner of each staging column, by name."""
    return {
        "transaction_id": clean.clean_prefixed_id(
            F.col("transaction_id"), "T", "transaction_id", mode
        ),
        "customer_id": clean.clean_customer_id(F.col("customer_id"), mode),
        "transaction_date": clean.clean_date(F.col("transaction_date"), mode),
        "product_id": clean.clean_prefixed_id(F.col("product_id"), "P", "product_id", mode),
        "product_name": F.col("product_name"),
        "quantity": clean.clean_quantity(F.col("quantity"), mode),
        "price": clean.clean_amount(F.col("price"), "price", mode),
        "tax": clean.clean_amount(F.col("tax"), "tax", mode),
        "loaded_at": F.col("loaded_at"),
    }


def clean_rows(raw: DataFrame, mode: str = clean.LENIENT) -> DataFrame:
    return raw.select(*[c.alias(name) for name, c in cleaned_columns(mode).items()])


def flag_valid(cleaned: DataFrame) -> DataFrame:
    """A row is valid when its three identifying fields survived cleaning."""
    present = F.lit(True)
    for name in IDENTIFYING:
        present = present & F.col(name).isNotNull()
    return cleaned.withColumn("is_valid", present)


def stage_transactions(raw: DataFrame, mode: str = clean.LENIENT) -> DataFrame:
    return flag_valid(clean_rows(raw, mode))


def digit_loss(raw: DataFrame) -> DataFrame:
    """Per amount column: how many numbers do not fit the decimal type exactly."""
    counts = raw.agg(
        *[F.count_if(clean.loses_digits(F.col(c))).alias(c) for c in ("price", "tax")]
    )
    return counts.unpivot([], ["price", "tax"], "column_name", "values_losing_digits")
