import datetime as dt
from decimal import Decimal

import pytest

from tallyspark.operators import audit, marts, ranking, star
from tallyspark.operators.staging import digit_loss, stage_transactions

D = Decimal


def row(tid, cust, date, product, qty, price, tax, name="Product A", **more):
    return {
        "transaction_id": tid,
        "customer_id": cust,
        "transaction_date": date,
        "product_id": product,
        "product_name": name,
        "quantity": qty,
        "price": price,
        "tax": tax,
        **more,
    }


@pytest.fixture(scope="module")
def staged(raw_rows):
    return stage_transactions(
        raw_rows(
            row("T1", "1.0", "2023-07-01", "P10", "2.0", "10.005", "0.004"),
            row("1", "1.0", "02-07-2023", "P11", "1.0", "10.005", "0.004", "Product B"),
            row("T2", "1.0", "2023-07-03", None, "1", "3", "1"),
            row("T3", "1.0", "2023-07-04", "P10", "1", "4", "Fifteen"),
            row("T4", "2.0", "2023-07-05", "P10", "5", "0", "2"),
            row(None, "2.0", "2023-07-05", "P10", "5", "1", "2"),
            row("T5", None, "2023-07-05", "P10", "5", "1", "2"),
            row("T6", "10.0", "2023/07/05", "P10", "few", "Two Hundred", "Fifteen"),
        )
    )


@pytest.fixture(scope="module")
def fact(staged):
    return marts.fact_transactions(staged)


def test_no_row_is_dropped_and_validity(staged):
    rows = staged.collect()
    assert len(rows) == 8
    assert [r.is_valid for r in rows] == [True] * 5 + [False] * 3


def test_fact_measures(fact):
    rows = {(r.transaction_id, r.product_id): r for r in fact.collect()}
    assert len(rows) == 4
    first = rows[1, 10]
    assert (first.gross_amount, first.total_amount) == (D("20.01"), D("20.01"))
    second = rows[1, 11]
    # 10.005 + 0.004 is rounded once: not 10.01 + 0.004.
    assert (second.gross_amount, second.total_amount) == (D("10.01"), D("10.01"))
    assert rows[4, 10].tax_rate_pct is None
    assert rows[2, None].tax_rate_pct == D("33.3333")


def test_agg_by_customer(fact):
    rows = {r.customer_id: r for r in marts.agg_by_customer(fact).collect()}
    one = rows[1]
    # 'T1' and '1' land as two rows with one id.
    assert one.total_transactions == 2
    assert one.product_ids == [10, 11, None]
    assert one.count_different_products == 2
    assert one.total_products == 4
    assert one.total_paid == D("34.02")
    assert one.total_taxes == D("1.01")
    assert (one.first_transaction_date, one.last_transaction_date) == (
        dt.date(2023, 7, 1),
        dt.date(2023, 7, 3),
    )
    assert rows[2].product_ids == [10]


def test_agg_by_product_and_pairs(fact):
    products = {(r.product_id, r.product_name): r for r in marts.agg_by_product(fact).collect()}
    assert products[10, "Product A"].customer_ids == [1, 2]
    assert products[None, "Product A"].customer_ids == [1]
    pairs = {(r.customer_id, r.product_id): r for r in marts.agg_by_customer_product(fact).collect()}
    assert len(pairs) == 4
    assert pairs[1, None].total_paid == D("4.00")


def test_dim_customers_counts_rows_without_tax(staged):
    one = {r.customer_id: r for r in marts.dim_customers(staged).collect()}[1]
    assert one.total_transactions == 3
    assert one.distinct_products_purchased == 2
    assert one.total_gross_amount == D("37.02")
    assert one.total_tax_paid == D("1.01")
    assert one.total_amount_incl_tax == D("34.02")
    assert one.avg_unit_price == D("6.75")


def test_average_is_rounded_once(raw_rows):
    rows = [row(f"T{i}", "1", "2023-07-01", "P1", "1", p, "1") for i, p in enumerate(["0.01", "0"])]
    one = marts.dim_customers(stage_transactions(raw_rows(*rows))).first()
    assert one.avg_unit_price == D("0.01")


def test_audits(staged):
    by_customer = {r.customer_id: r for r in audit.errors_by_customer(staged).collect()}
    assert by_customer["NULL"].total_rows_with_errors == 1
    assert by_customer["1"].null_tax == 1 and by_customer["1"].total_rows == 4
    ten = by_customer["10"]
    assert (ten.null_transaction_date, ten.null_quantity, ten.null_price) == (1, 1, 1)
    assert "null_customer_id" not in by_customer["1"]
    day = audit.errors_by_load_date(staged).first()
    assert (day.load_date, day.total_rows, day.null_customer_id) == (dt.date(2024, 1, 31), 8, 1)
    assert sum(r.total_rows for r in by_customer.values()) == day.total_rows


def test_text_order_of_the_audit(spark):
    df = spark.createDataFrame(
        [("9", 1), ("10", 1), ("NULL", 5)], "customer_id string, total_rows_with_errors long"
    )
    got = [r.customer_id for r in ranking.sorted_mart("audit_errors_by_customer", df).collect()]
    assert got == ["NULL", "10", "9"]


def test_null_order_and_top(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9), (None, 9)], "k int, m int")
    assert [r.k for r in ranking.in_order(df, ["k"]).collect()] == [1, 2, 3, None]
    assert [r.m for r in ranking.in_order(df, ["-m", "k"]).collect()] == [None, 9, 9, 5]
    assert [r.k for r in ranking.top(df, "m", ["k"], ["k"]).collect()] == [3, None, 1]
    assert ranking.top(df, "m", ["k"], ["k"], n=10).count() == 4


def test_star(fact):
    products = {r.product_id: r.product_name for r in star.dim_products(fact).collect()}
    assert products == {10: "Product A", 11: "Product B"}
    dates = star.dim_date(fact).orderBy("date_id").collect()
    assert len(dates) == 5
    assert (dates[0].month_name, dates[0].day_of_week, dates[0].is_weekend) == (
        "July",
        "Saturday",
        True,
    )
    assert "product_name" not in star.fact_star(fact).columns


def test_renamed_product_takes_the_latest_name(raw_rows):
    rows = [
        row("T1", "1", "2023-07-02", "P1", "1", "1", "1", "new"),
        row("T2", "1", "2023-07-01", "P1", "1", "1", "1", "old"),
    ]
    fact = marts.fact_transactions(stage_transactions(raw_rows(*rows)))
    assert star.dim_products(fact).first().product_name == "new"


def test_digit_loss_is_counted(raw_rows):
    raw = raw_rows(row("T1", "1", "2023-07-02", "P1", "1", "1.12345678911", "1"))
    assert {r.column_name: r.values_losing_digits for r in digit_loss(raw).collect()} == {
        "price": 1,
        "tax": 0,
    }


def test_strict_equals_lenient_on_clean_rows(raw_rows):
    raw = raw_rows(row("T1", "1.0", "2023-07-02", "P1", "1", "1.5", "Fifteen"), row(*[None] * 7))
    assert stage_transactions(raw, "strict").collect() == stage_transactions(raw).collect()
