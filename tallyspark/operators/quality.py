"""Declarative checks: unique, not null, relationships, accepted values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.schemas import ACCEPTED_PRODUCT_NAMES

REPORT = ("table_name", "column_name", "test_name", "failures")


class DataQualityError(RuntimeError):
    """A check of the suite failed."""


@dataclass(frozen=True)
class TableChecks:
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted_values: Mapping[str, Sequence[str]] = field(default_factory=dict)
    # column -> (parent table, parent column)
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)


# The declared checks, 29 in all.
SUITE = {
    "stg_customer_transactions": TableChecks(not_null=["is_valid"]),
    "dim_customers": TableChecks(
        not_null=[
            "customer_id",
            "first_transaction_date",
            "last_transaction_date",
            "total_transactions",
        ],
        unique=["customer_id"],
    ),
    "fact_transactions": TableChecks(
        not_null=[
            "transaction_id",
            "customer_id",
            "product_id",
            "product_name",
            "transaction_date",
            "quantity",
            "unit_price",
            "tax",
            "gross_amount",
            "total_amount",
        ],
        unique=["transaction_id"],
        accepted_values={"product_name": ACCEPTED_PRODUCT_NAMES},
        relationships={"customer_id": ("dim_customers", "customer_id")},
    ),
    "agg_by_customer": TableChecks(
        not_null=["customer_id", "total_transactions", "total_paid"], unique=["customer_id"]
    ),
    "agg_by_customer_product": TableChecks(not_null=["customer_id", "product_id", "total_paid"]),
    "agg_by_product": TableChecks(not_null=["product_id", "total_paid"], unique=["product_id"]),
}


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with NULL, per column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without parent and how many rows hold each.

    Both sides have one row per key before they join, so a hot key stays small.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("child_rows"))
    )
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return keys.join(known, column, "left_anti")


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the list; NULL passes."""
    return (
        df.where(~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def _report(table: str, test: str, counts: DataFrame) -> DataFrame:
    return counts.select(
        F.lit(table).alias("table_name"), "column_name", F.lit(test).alias("test_name"), "failures"
    )


def _total(column: str, failing: DataFrame, failures) -> DataFrame:
    return failing.agg(failures.alias("failures")).select(
        F.lit(column).alias("column_name"), "failures"
    )


def row_checks(table: str, df: DataFrame, checks: TableChecks) -> DataFrame:
    """Not-null and accepted-value checks of a table, in one pass over it."""
    counts = {(c, "not_null"): F.count_if(F.col(c).isNull()) for c in checks.not_null}
    counts |= {
        (c, "accepted_values"): F.count_distinct(F.when(~F.col(c).isin(*accepted), F.col(c)))
        for c, accepted in checks.accepted_values.items()
    }
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(test).alias("test_name"),
            F.col(f"_{k}").alias("failures"),
        )
        for k, (column, test) in enumerate(counts)
    ]
    totals = df.agg(*[count.alias(f"_{k}") for k, count in enumerate(counts.values())])
    return totals.select(F.inline(F.array(*rows)))


def run_suite(
    tables: Mapping[str, DataFrame], suite: Mapping[str, TableChecks] = SUITE
) -> DataFrame:
    """One row per check. All row checks of a table share one pass over it.

    Pass written tables: each key check reads its table again.
    """
    results = []
    for name, checks in suite.items():
        df = tables[name]
        if checks.not_null or checks.accepted_values:
            results.append(row_checks(name, df, checks))
        for column in checks.unique:
            count = _total(column, duplicated_values(df, column), F.count(F.lit(1)))
            results.append(_report(name, "unique", count))
        for column, (parent, parent_column) in checks.relationships.items():
            missing = orphans(df, column, tables[parent], parent_column)
            count = _total(column, missing, F.coalesce(F.sum("child_rows"), F.lit(0)))
            results.append(_report(name, "relationships", count))
    report = reduce(DataFrame.unionByName, results)
    return report.withColumn("passed", F.col("failures") == 0)


def gate(report: DataFrame) -> None:
    """Fail the run if any check failed; the report has one row per check."""
    failed = report.where(~F.col("passed")).select(*REPORT).collect()
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.test_name}: {r.failures}" for r in failed]
        raise DataQualityError("; ".join(sorted(lines)))
