import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyspark.functions import student_t
from tallyspark.functions.student_t import correlation_p_value, gamma_ratio
from tallyspark.operators import statistics
from tallyspark.operators.quantiles import quantiles, value_counts

VALUES = st.lists(
    st.one_of(
        st.sampled_from([0.0, 1.0, -1.0, 0.001, 1e9]),
        st.floats(-1e12, 1e12, allow_nan=False).map(lambda x: round(x, 6) + 0.0),
    ),
    min_size=1,
    max_size=60,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=VALUES, b=VALUES)
def test_quantiles_equal_numpy(spark, a, b):
    df = spark.createDataFrame(
        [("a", v) for v in a] + [("b", v) for v in b] + [("a", None)], "g string, v double"
    )
    got = {r.g: (r.q25, r.q50, r.q75) for r in quantiles(value_counts(df, "g", "v"), "g").collect()}
    for group, values in (("a", a), ("b", b)):
        np.testing.assert_allclose(got[group], np.quantile(values, [0.25, 0.5, 0.75]), rtol=1e-9)


def test_quantiles_of_a_hot_group(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("g"),
        ((F.col("id") * 7919) % 50_021 / 100).alias("v"),
    )
    got = {r.g: (r.q25, r.q50, r.q75) for r in quantiles(value_counts(df, "g", "v"), "g").collect()}
    local = df.toPandas()
    for group, rows in local.groupby("g"):
        np.testing.assert_allclose(got[group], rows.v.quantile([0.25, 0.5, 0.75]), rtol=1e-12)


@pytest.fixture(scope="module")
def points(spark):
    random = np.random.default_rng(7)
    pdf = pd.DataFrame(
        {
            "x": random.integers(1, 9, 300).astype(float),
            "y": random.normal(5, 3, 300),
            "product_name": random.choice(["A", "B"], 300),
        }
    )
    pdf["z"] = pdf.x * 2 + random.normal(0, 1, 300)
    pdf.loc[::11, "z"] = None
    pdf["c"] = 4.0
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "x double, y double, product_name string, z double, c double")
    return df, pdf


def test_describe(points):
    df, pdf = points
    expected = pdf[["x", "y", "z", "c"]].describe()
    for r in statistics.describe_numeric(df, ["x", "y", "z", "c"]).collect():
        got = [r["count"], r["mean"], r["std"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]]
        np.testing.assert_allclose(got, expected[r.column_name], rtol=1e-9, atol=1e-12)


def test_describe_of_a_single_row_has_no_deviation(spark):
    df = spark.createDataFrame([(3.0,)], "x double")
    assert statistics.describe_numeric(df, ["x"]).first()["std"] is None


def test_correlation_is_pairwise_and_null_for_constants(points):
    df, pdf = points
    expected = pdf[["x", "y", "z", "c"]].corr()
    rows = statistics.correlation_matrix(df, ["x", "y", "z", "c"]).collect()
    assert len(rows) == 16
    for r in rows:
        value = expected.loc[r.column_a, r.column_b]
        if math.isnan(value):
            assert r.r is None
        else:
            assert r.r == pytest.approx(value, rel=1e-9)


def test_linear_fit(points):
    df, pdf = points
    fit = statistics.linear_fit(df, "x", "z").first()
    both = pdf.dropna()
    slope, intercept = np.polyfit(both.x, both.z, 1)
    assert (fit.slope, fit.intercept) == pytest.approx((slope, intercept))
    assert fit.n == len(both)
    flat = statistics.linear_fit(df, "c", "x").first()
    assert flat.slope is None and flat.r is None
    assert statistics.linear_fit(df, "x", "c").first().r == 0.0


def test_lines(spark):
    fit = spark.createDataFrame([(2.0, 1.0, 2.9, 6.2)], "slope double, intercept double, min_x double, max_x double")
    assert [(r.x, r.y) for r in statistics.quantity_line(fit).orderBy("x").collect()] == [
        (i, 2.0 * i + 1) for i in range(1, 6)
    ]
    assert [r.x for r in statistics.price_line(fit).orderBy("x").collect()] == [2, 3, 4, 5]
    narrow = fit.withColumn("max_x", F.lit(2.95))
    assert statistics.price_line(narrow).count() == 0
    wide = fit.withColumn("max_x", F.lit(20_000.0))
    xs = [r.x for r in statistics.price_line(wide).orderBy("x").collect()]
    assert xs == list(range(2, 20_000))


# Known values of Student's t distribution: (t, degrees of freedom, two-sided p).
@pytest.mark.parametrize(
    "t,df,p",
    [
        (12.706204736432095, 1, 0.05),
        (2.2281388519649385, 10, 0.05),
        (3.169272667175838, 10, 0.01),
        (1.959963984540054, 10**9, 0.05),
        (1.0, 1, 0.5),
    ],
)
def test_p_value(t, df, p):
    r = t / math.sqrt(t * t + df)
    assert correlation_p_value(r, df + 2) == pytest.approx(p, rel=1e-6)
    assert correlation_p_value(-r, df + 2) == pytest.approx(p, rel=1e-6)


def test_p_value_limits():
    assert correlation_p_value(1.0, 10) == 0.0
    assert correlation_p_value(0.0, 10) == pytest.approx(1.0)
    assert correlation_p_value(None, 10) is None
    assert correlation_p_value(0.5, 1) is None
    assert gamma_ratio(0.5) == pytest.approx(1 / math.sqrt(math.pi), rel=1e-13)
    assert gamma_ratio(3.0) == pytest.approx(math.gamma(3.5) / 2, rel=1e-13)


def integrated_p_value(t, n):
    """The t density by Simpson's rule."""

    def area(start, stop, steps=40_000):
        h = (stop - start) / steps
        values = [
            math.exp(-(n - 1) / 2 * math.log1p((start + k * h) ** 2 / (n - 2)))
            * (1 if k in (0, steps) else 4 if k % 2 else 2)
            for k in range(steps + 1)
        ]
        return math.fsum(values) * h / 3

    return area(t, t + 40) / area(0, 60)


@pytest.mark.parametrize("n", [40, 10**4, 10**7 - 1, 10**7, 10**7 + 1, 10**9])
@pytest.mark.parametrize("t", [0.01, 0.5, 3.0, 6.0])
def test_p_value_is_one_formula_for_every_size(t, n):
    r = t / math.sqrt(t * t + n - 2)
    assert correlation_p_value(r, n) == pytest.approx(integrated_p_value(t, n), rel=1e-9)


def test_p_value_does_not_return_unsettled_values(monkeypatch):
    monkeypatch.setattr(student_t, "_MAX_STEPS", 2)
    with pytest.raises(ArithmeticError):
        correlation_p_value(0.3, 30)


def test_with_p_value(points):
    df, _ = points
    row = statistics.with_p_value(statistics.linear_fit(df, "x", "y")).first()
    assert 0.0 <= row.p_value <= 1.0


def test_boxplot(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([("A", v) for v in values], "product_name string, unit_price double")
    r = statistics.boxplot_stats(df).first()
    assert (r.q25, r.q50, r.q75) == (2.25, 3.5, 4.75)
    assert (r.whisker_low, r.whisker_high, r.outliers) == (1.0, 5.0, 1)


def test_pivot(spark):
    pairs = spark.createDataFrame(
        [(1, 10, "A", 2), (1, 11, "A", 3), (2, 12, "B", 1)],
        "customer_id int, product_id int, product_name string, total_transactions long",
    )
    got = {r.customer_id: (r.A, r.B) for r in statistics.customer_product_pivot(pairs, ["A", "B"]).collect()}
    assert got == {1: (5, 0), 2: (0, 1)}
    with pytest.raises(PySparkException, match="several rows"):
        statistics.customer_product_pivot(pairs, ["A", "B"], on_repeat="raise").collect()
    with pytest.raises(PySparkException, match="unlisted product name: B"):
        statistics.customer_product_pivot(pairs, ["A"]).collect()


def test_scatter_bins_keep_every_point(points):
    df, pdf = points
    bins = statistics.scatter_bins(df, "x", "y", 2, 5)
    assert bins.agg(F.sum("points")).first()[0] == len(pdf)


def test_a_missing_name_is_not_the_name_null(spark):
    pairs = spark.createDataFrame(
        [(1, 10, "NULL", 2), (1, 11, None, 3), (2, 12, None, 1), (2, 13, "A", 4), (3, 14, "NULL", 7)],
        "customer_id int, product_id int, product_name string, total_transactions long",
    )
    wide = statistics.customer_product_pivot(pairs)
    assert wide.columns == ["customer_id", "NULL (missing)", "A", "NULL"]
    assert sorted(map(tuple, wide.collect())) == [(1, 3, 0, 2), (2, 1, 4, 0), (3, 0, 0, 7)]
    alone = statistics.customer_product_pivot(pairs.where("product_name IS NULL OR product_name = 'A'"))
    assert alone.columns == ["customer_id", "NULL", "A"]
    names = statistics.numbered_names(pairs)
    assert sorted(map(tuple, names.collect())) == [(0, None), (1, "A"), (2, "NULL")]
    sparse = statistics.customer_product_sparse(pairs, names)
    assert sorted(map(tuple, sparse.collect())) == [(1, [0, 2], [3, 2]), (2, [0, 1], [1, 4]), (3, [2], [7])]


def test_more_names_than_columns(spark, monkeypatch):
    """Names in many ranges are numbered without a gap; the dense form refuses them."""
    monkeypatch.setattr(statistics, "MAX_PIVOT_COLUMNS", 100)
    pairs = spark.range(20_000).select(
        (F.col("id") % 7).cast("int").alias("customer_id"),
        F.concat(F.lit("n"), F.col("id") % 5000).alias("product_name"),
        F.lit(1).cast("long").alias("total_transactions"),
    )
    with pytest.raises(ValueError, match="customer_product_sparse"):
        statistics.customer_product_pivot(pairs)
    names = statistics.numbered_names(pairs)
    in_order = sorted(f"n{k}" for k in range(5000))
    assert [(r.name_no, r.product_name) for r in names.orderBy("name_no").collect()] == list(enumerate(in_order))
    rows = statistics.customer_product_sparse(pairs, names).collect()
    assert sum(sum(r.transactions) for r in rows) == 20_000 and all(r.name_nos == sorted(r.name_nos) for r in rows)


def test_points_of_every_product(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") < 3000, F.concat(F.lit("p"), F.col("id") % 9)).alias("product_name"),
        *[F.col("id").cast("int").alias(c) for c in ("transaction_id", "customer_id", "product_id")],
        F.lit("2024-01-01").cast("date").alias("transaction_date"),
        *[F.col("id").cast("int").alias(c) for c in statistics.POINT_COLUMNS],
    )
    sample = statistics.scatter_points(df, 50)
    found = sorted(map(str, sample.collect()))
    counts = {r.product_name: r["count"] for r in sample.groupBy("product_name").count().collect()}
    assert counts == {"hot": 50, None: 50, "p0": 50, "p3": 50, "p6": 50}
    assert found == sorted(map(str, statistics.scatter_points(df.repartition(13), 50).collect()))
    parts = [statistics.scatter_points(df.where(f"transaction_id % 4 = {k}"), 50) for k in range(4)]
    united = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    assert found == sorted(map(str, statistics.scatter_points(united, 50).collect()))
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
