"""One customer, product and name hold a third of the rows: brute force agrees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import audit, marts, quality, star, statistics


@pytest.fixture(scope="module")
def fact(spark):
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(0, 9000, numPartitions=5).select(
        (i % 8000).cast("int").alias("transaction_id"),
        F.when(hot, 1).otherwise(i % 400).cast("int").alias("customer_id"),
        F.when(hot, F.when(i % 30 == 0, None).otherwise(7))
        .otherwise(i % 90)
        .cast("int")
        .alias("product_id"),
        F.when(hot, "Product A").otherwise(F.concat(F.lit("Product "), i % 4)).alias("product_name"),
        F.date_add(F.lit("2023-01-01").cast("date"), (i % 500).cast("int")).alias("transaction_date"),
        (i % 9 + 1).cast("int").alias("quantity"),
        (i * 37 % 1001 / 7).cast("decimal(20,6)").alias("unit_price"),
        (i % 13).cast("decimal(20,6)").alias("tax"),
        (i * 11 % 997).cast("decimal(38,2)").alias("gross_amount"),
        (i * 11 % 997 + i % 13).cast("decimal(38,2)").alias("total_amount"),
    )


@pytest.fixture(scope="module")
def local(fact):
    return fact.toPandas()


def test_customers(fact, local):
    got = {r.customer_id: r for r in marts.agg_by_customer(fact).collect()}
    assert set(got) == set(local.customer_id)
    for key, rows in local.groupby("customer_id"):
        r, products = got[key], set(rows.product_id.dropna().astype(int))
        tail = [None] if rows.product_id.isna().any() else []
        assert r.product_ids == sorted(products) + tail
        assert r.count_different_products == len(products)
        assert r.total_transactions == rows.transaction_id.nunique()
        assert r.total_products == rows.quantity.sum()
        assert r.total_paid == rows.total_amount.sum()


def test_products(fact, local):
    got = {(r.product_id, r.product_name): r for r in marts.agg_by_product(fact).collect()}
    groups = list(local.groupby(["product_id", "product_name"], dropna=False))
    assert len(got) == len(groups)
    for (product, name), rows in groups:
        r = got[None if np.isnan(product) else int(product), name]
        assert r.customer_ids == sorted(set(rows.customer_id))
        assert r.total_transactions == rows.transaction_id.nunique()


def test_box_plots(fact, local):
    got = {r.product_name: r for r in statistics.boxplot_stats(fact).collect()}
    for name, rows in local.groupby("product_name"):
        v = rows.unit_price.astype(float).to_numpy()
        q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        r = got[name]
        np.testing.assert_allclose((r.q25, r.q50, r.q75), (q1, q2, q3), rtol=1e-12)
        assert (r.whisker_low, r.whisker_high) == (v[v >= low].min(), v[v <= high].max())
        assert (r["count"], r.outliers) == (len(v), ((v < low) | (v > high)).sum())


def test_whiskers_on_negative_and_mixed_values(spark):
    random = np.random.default_rng(3)
    values = np.round(np.concatenate([random.normal(-5, 4, 400), random.normal(300, 9, 9), [-900.0]]), 3)
    df = spark.createDataFrame([("A", float(v)) for v in values], "product_name string, unit_price double")
    r = statistics.boxplot_stats(df).first()
    q1, q3 = np.quantile(values, [0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert r.whisker_low == values[values >= low].min()
    assert r.whisker_high == values[values <= high].max()
    assert r.outliers == ((values < low) | (values > high)).sum()


def test_relationships_and_uniqueness(fact, local):
    parent = fact.where("customer_id <> 1")
    missing = quality.orphans(fact, "customer_id", parent, "customer_id").collect()
    assert [(r.customer_id, r.child_rows) for r in missing] == [(1, (local.customer_id == 1).sum())]
    repeated = quality.duplicated_values(fact, "transaction_id").count()
    assert repeated == (local.transaction_id.value_counts() > 1).sum()


def test_star_slice(fact, local):
    staged = fact.withColumn("is_valid", F.lit(True)).withColumnRenamed("unit_price", "price")
    sliced = star.star_slice(
        star.fact_star(fact.withColumns({"tax_rate_pct": F.lit(0), "loaded_at": F.lit(0)})),
        marts.dim_customers(staged),
        star.dim_products(fact),
        star.dim_date(fact),
        7,
    )
    months = local.transaction_date.map(lambda d: d.month)
    july = local[(months == 7) & local.product_id.notna()]
    total = sliced.agg(F.sum("transactions"), F.sum("units"), F.sum("revenue")).first()
    assert tuple(total) == (len(july), july.quantity.sum(), july.total_amount.sum())


def test_audit_totals(spark, raw_rows):
    from tallyspark.operators.staging import stage_transactions

    rows = raw_rows(*[{"transaction_id": f"T{i}", "customer_id": None} for i in range(50)], {})
    staged = stage_transactions(rows)
    assert audit.errors_by_customer(staged).first().total_rows == 51
