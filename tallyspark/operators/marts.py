"""Fact table, customer dimension and the aggregate marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.arrays import sorted_with_null_last
from tallyspark.functions.decimals import rounded_quotient
from tallyspark.schemas import AMOUNT_SCALE, MONEY, RATE


_SLICE = "__slice"


def valid_rows(staged: DataFrame) -> DataFrame:
    return staged.where("is_valid")


def priced_rows(staged: DataFrame) -> DataFrame:
    """Rows the customer dimension counts; the tax may be missing."""
    return valid_rows(staged).where("price IS NOT NULL AND quantity IS NOT NULL")


def measured_rows(staged: DataFrame) -> DataFrame:
    """Rows the fact table holds: price, quantity and tax are all present."""
    return priced_rows(staged).where("tax IS NOT NULL")


def gross() -> Column:
    return F.col("price") * F.col("quantity")


def gross_amount() -> Column:
    return F.round(gross(), 2).cast(MONEY)


def total_amount() -> Column:
    """Rounded once, from the unrounded gross."""
    return F.round(gross() + F.col("tax"), 2).cast(MONEY)


def tax_rate_pct() -> Column:
    """NULL where the gross is zero."""
    return rounded_quotient(F.col("tax") * F.lit(100), gross(), 4).cast(RATE)


def fact_transactions(staged: DataFrame) -> DataFrame:
    return measured_rows(staged).select(
        "transaction_id",
        "customer_id",
        "product_id",
        "product_name",
        "transaction_date",
        "quantity",
        F.col("price").alias("unit_price"),
        "tax",
        gross_amount().alias("gross_amount"),
        total_amount().alias("total_amount"),
        tax_rate_pct().alias("tax_rate_pct"),
        "loaded_at",
    )


def mean_amount(column: str) -> Column:
    """Mean of an amount, rounded once; ``avg`` of a decimal would round twice."""
    total = F.sum(column).cast(f"decimal(34,{AMOUNT_SCALE})")
    return rounded_quotient(total, F.count(column).cast("decimal(20,0)"), 2).cast(MONEY)


def _money(column: Column) -> Column:
    return F.round(column, 2).cast(MONEY)


# Fixed value: the parts a key's transactions are dealt to, before they are added up by key.
_SLICES = 32


def _sliced(rows: DataFrame, keys: Sequence[str], member: str, columns: Sequence[str]) -> DataFrame:
    """Rows dealt by key and a slice of their transactions, in one shuffle of one row each.

    Distinct counts of a slice add up, as a transaction lies in one slice, so that distinct
    aggregates need no copy of the rows for each of them. A hot key spreads over the slices.
    """
    slices = F.pmod(F.hash("transaction_id"), F.lit(_SLICES)).alias(_SLICE)
    needed = dict.fromkeys([*keys, "transaction_id", "transaction_date", member, *columns])
    return rows.select(*needed, slices).repartition(*keys, _SLICE)


def _by_key(
    rows: DataFrame,
    keys: Sequence[str],
    member: str,
    columns: Sequence[str],
    sums: Mapping[str, Column],
    result: Sequence[Column],
) -> DataFrame:
    """Per key: distinct transactions, first and last day, distinct members, and sums.

    ``sums`` maps names to aggregates whose parts add up; ``result`` is made of them and of
    ``total_transactions``, ``members``, ``member_list`` and the days. The sets of a slice
    hold distinct values only, and one key's members go together last.
    """
    of_slice = _sliced(rows, keys, member, columns).groupBy(*keys, _SLICE).agg(
        F.size(F.collect_set("transaction_id")).cast("long").alias("total_transactions"),
        F.min("transaction_date").alias("first_transaction_date"),
        F.max("transaction_date").alias("last_transaction_date"),
        F.collect_set(member).alias("members"),
        F.count_if(F.col(member).isNull()).alias("without_member"),
        *[made.alias(name) for name, made in sums.items()],
    )
    members = F.array_distinct(F.flatten(F.collect_list("members")))
    whole = of_slice.groupBy(*keys).agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.min("first_transaction_date").alias("first_transaction_date"),
        F.max("last_transaction_date").alias("last_transaction_date"),
        members.alias("members"),
        F.sum("without_member").alias("without_member"),
        *[F.sum(name).alias(name) for name in sums],
    )
    member_list = sorted_with_null_last(F.col("members"), F.col("without_member") > 0)
    shown = whole.withColumns(
        {"member_list": member_list, "members": F.size("members").cast("long")}
    )
    return shown.select(*keys, *result)


def dim_customers(staged: DataFrame) -> DataFrame:
    """One row per customer; sums are rounded once, after adding up."""
    prices = F.col("prices").cast(f"decimal(34,{AMOUNT_SCALE})")
    return _by_key(
        priced_rows(staged),
        ["customer_id"],
        "product_id",
        ["quantity", "price", "tax"],
        {
            "gross": F.sum(gross()),
            "taxes": F.sum("tax"),
            "paid": F.sum(gross() + F.col("tax")),
            "prices": F.sum("price"),
            "priced": F.count("price"),
        },
        [
            F.col("first_transaction_date"),
            F.col("last_transaction_date"),
            F.col("total_transactions"),
            F.col("members").alias("distinct_products_purchased"),
            _money(F.col("gross")).alias("total_gross_amount"),
            _money(F.col("taxes")).alias("total_tax_paid"),
            _money(F.col("paid")).alias("total_amount_incl_tax"),
            rounded_quotient(prices, F.col("priced").cast("decimal(20,0)"), 2).cast(MONEY).alias("avg_unit_price"),
        ],
    )


def _sums(units: str) -> list[Column]:
    return [
        F.sum("quantity").alias(units),
        _money(F.sum("total_amount")).alias("total_paid"),
        _money(F.sum("tax")).alias("total_taxes"),
    ]


def _with_members(fact: DataFrame, keys: Sequence[str], member: str, array: str, count: str) -> DataFrame:
    amounts = ["quantity", "total_amount", "tax"]
    return _by_key(
        fact,
        keys,
        member,
        amounts,
        {name: F.sum(name) for name in amounts},
        [
            F.col("total_transactions"),
            F.col("first_transaction_date"),
            F.col("last_transaction_date"),
            F.col("members").alias(count),
            F.col("member_list").alias(array),
            F.col("quantity").alias("total_products"),
            _money(F.col("total_amount")).alias("total_paid"),
            _money(F.col("tax")).alias("total_taxes"),
        ],
    )


def agg_by_customer(fact: DataFrame) -> DataFrame:
    return _with_members(
        fact, ["customer_id"], "product_id", "product_ids", "count_different_products"
    )


def agg_by_product(fact: DataFrame) -> DataFrame:
    return _with_members(
        fact, ["product_id", "product_name"], "customer_id", "customer_ids", "count_different_customers"
    )


def agg_by_customer_product(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id", "product_id", "product_name").agg(
        F.count_distinct("transaction_id").alias("total_transactions"),
        F.min("transaction_date").alias("first_transaction_date"),
        F.max("transaction_date").alias("last_transaction_date"),
        *_sums("total_quantity"),
    )
