"""Array helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_with_null_last(values: Column, has_null: Column, element: str = "int") -> Column:
    """Sorted array of non-null values, followed by one NULL if there was any."""
    tail = F.when(has_null, F.array(F.lit(None).cast(element))).otherwise(
        F.array().cast(f"array<{element}>")
    )
    return F.concat(F.sort_array(values), tail)


def as_text(values: Column) -> Column:
    """Array shown as comma-separated text, NULL elements as the word NULL."""
    return F.array_join(values.cast("array<string>"), ",", "NULL")
