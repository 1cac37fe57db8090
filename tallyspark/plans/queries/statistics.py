"""Exploratory statistics. Floating-point results are rounded for comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import marts, statistics
from tallyspark.plans.queries.base import fact, query
from tallyspark.schemas import FACT_MEASURES
from tallyspark.session import materialize


# Digits that are compared of a floating-point result, whatever its magnitude.
DIGITS = 9


def _short(name: str, digits: int = DIGITS) -> Column:
    text = F.format_string(f"%.{digits - 1}e", F.col(name))
    return (F.when(F.col(name).isNotNull(), text.cast("double")) + F.lit(0.0)).alias(name)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round double columns to so many digits; also turns a negative zero into zero."""

    return df.select(*[_short(name, digits) if kind == "double" else name for name, kind in df.dtypes])


def _rounded_sql(expression: str) -> str:
    return f"CAST(printf('%.{DIGITS - 1}e', {expression}) AS DOUBLE) + 0.0"


@query(
    "row_counts",
    """SELECT 'fact_transactions' AS table_name, count(*) AS row_count FROM {fact}
       UNION ALL SELECT 'agg_by_customer', count(*) FROM {agg_by_customer}
       UNION ALL SELECT 'agg_by_product', count(*) FROM {agg_by_product}""",
)
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.mart_row_counts(fact(spark, sf_dir))


DESCRIBE_SQL = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count,
    {_rounded_sql(f"avg(CAST({c} AS DOUBLE))")} AS mean,
    {_rounded_sql(f"stddev_samp(CAST({c} AS DOUBLE))")} AS std,
    {_rounded_sql(f"CAST(min({c}) AS DOUBLE)")} AS min,
    {_rounded_sql(f"quantile_cont(CAST({c} AS DOUBLE), 0.25)")} AS q25,
    {_rounded_sql(f"quantile_cont(CAST({c} AS DOUBLE), 0.5)")} AS q50,
    {_rounded_sql(f"quantile_cont(CAST({c} AS DOUBLE), 0.75)")} AS q75,
    {_rounded_sql(f"CAST(max({c}) AS DOUBLE)")} AS max FROM {{fact}}"""
    for c in FACT_MEASURES
)


@query("describe_numeric", DESCRIBE_SQL)
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two passes, hence over the written columns."""
    measures = fact(spark, sf_dir).select(*FACT_MEASURES)
    return rounded(statistics.describe_numeric(materialize(measures, "measures")))


@query(
    "correlation_matrix",
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
        + _rounded_sql(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))")
        + " AS r FROM {fact}"
        for a in FACT_MEASURES
        for b in FACT_MEASURES
    ),
)
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(statistics.correlation_matrix(fact(spark, sf_dir)))


BOXPLOT_SQL = f"""SELECT product_name, count(*) AS count,
        {_rounded_sql("any_value(q25)")} AS q25, {_rounded_sql("any_value(q50)")} AS q50,
        {_rounded_sql("any_value(q75)")} AS q75,
        {_rounded_sql("least(min(v) FILTER (v >= q25 - 1.5 * (q75 - q25)), any_value(q25))")}
            AS whisker_low,
        {_rounded_sql("greatest(max(v) FILTER (v <= q75 + 1.5 * (q75 - q25)), any_value(q75))")}
            AS whisker_high,
        count(*) FILTER (v < q25 - 1.5 * (q75 - q25) OR v > q75 + 1.5 * (q75 - q25)) AS outliers
        FROM (SELECT product_name, CAST(unit_price AS DOUBLE) AS v FROM {{fact}}) AS x
        JOIN (SELECT product_name,
              quantile_cont(CAST(unit_price AS DOUBLE), 0.25) AS q25,
              quantile_cont(CAST(unit_price AS DOUBLE), 0.5) AS q50,
              quantile_cont(CAST(unit_price AS DOUBLE), 0.75) AS q75
              FROM {{fact}} GROUP BY product_name) AS q USING (product_name)
        GROUP BY product_name"""


@query("boxplot_stats", BOXPLOT_SQL)
def boxplot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(statistics.boxplot_stats(fact(spark, sf_dir)))


# The two fits: name -> (x, y).
_FITS = {"quantity_gross": ("quantity", "gross_amount"), "price_tax": ("unit_price", "tax")}


def _fit_sql(x: str, y: str) -> str:
    cx, cy = f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"
    return f"""SELECT {_rounded_sql(f"regr_slope({cy}, {cx})")} AS slope,
        {_rounded_sql(f"regr_intercept({cy}, {cx})")} AS intercept,
        {_rounded_sql(f"corr({cy}, {cx})")} AS r, CAST(regr_count({cy}, {cx}) AS BIGINT) AS n,
        {_rounded_sql(f"min({cx})")} AS min_x, {_rounded_sql(f"max({cx})")} AS max_x
        FROM {{fact}}"""


for _name, (_x, _y) in _FITS.items():
    query(f"linreg_{_name}", _fit_sql(_x, _y))(
        lambda spark, sf_dir, x=_x, y=_y: rounded(
            statistics.linear_fit(fact(spark, sf_dir), x, y)
        )
    )


# A pair without a strong connection, so that one p-value is neither 0 nor 1.
_TESTED = {**_FITS, "quantity_price": ("quantity", "unit_price")}


def _p_value_sql() -> str:
    """The t density integrated by Simpson's rule: 40 units of tail over 60 units from 0."""
    fits = " UNION ALL ".join(
        f"SELECT '{name}' AS fit, corr(CAST({y} AS DOUBLE), CAST({x} AS DOUBLE)) AS r,"
        f" CAST(regr_count(CAST({y} AS DOUBLE), CAST({x} AS DOUBLE)) AS BIGINT) AS n FROM {{fact}}"
        for name, (x, y) in _TESTED.items()
    )
    weight = "CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    density = "exp(-(n - 1) / 2.0 * ln(1 + ({u}) * ({u}) / (n - 2)))"
    tail, whole = density.replace("{u}", "t + i * 0.002"), density.replace("{u}", "i * 0.003")
    return f"""SELECT fit, {_rounded_sql("r")} AS r, n, round(sum({weight} * {tail}) * 0.002
            / (sum({weight} * {whole}) * 0.003), 9) + 0.0 AS p_value
        FROM (SELECT *, abs(r) * sqrt((n - 2) / ((1 - r) * (1 + r))) AS t FROM ({fits}) AS f) AS g,
             range(20001) AS steps(i)
        GROUP BY fit, r, n"""


@query("linreg_p_values", _p_value_sql())
def linreg_p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fits with their p-values, from one pass over the fact."""
    fits = statistics.linear_fits(fact(spark, sf_dir), _TESTED).select("fit", "r", "n")
    return statistics.with_p_value(fits).select(
        "fit",
        _short("r"),
        "n",
        (F.round("p_value", 9) + F.lit(0.0)).alias("p_value"),
    )


def _line_sql(name: str, x: str, y: str, first: str, last: str) -> str:
    """Whole x from first to last, in steps beyond 20,000 of them, the last one in any case."""
    cx, cy = f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"
    return f"""SELECT '{name}' AS fit, x, {_rounded_sql("slope * x + intercept")} AS y
        FROM (SELECT slope, intercept, CAST(unnest(list_distinct(list_append(
                generate_series(lo, hi, (hi - lo) // {statistics.LINE_POINTS} + 1), hi))) AS BIGINT) AS x
              FROM (SELECT regr_slope({cy}, {cx}) AS slope, regr_intercept({cy}, {cx}) AS intercept,
                    CAST({first} AS BIGINT) AS lo, CAST({last} AS BIGINT) AS hi FROM {{fact}}) AS f) AS p"""


@query(
    "regression_line",
    _line_sql("quantity_gross", *_FITS["quantity_gross"], "1", "5")
    + " UNION ALL "
    + _line_sql("price_tax", *_FITS["price_tax"], "floor(min(unit_price))", "floor(max(unit_price)) - 1"),
)
def regression_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    fits = statistics.linear_fits(fact(spark, sf_dir), _FITS)
    is_quantity = F.col("fit") == "quantity_gross"
    first, last = (
        F.when(is_quantity, of_quantity).otherwise(of_price)
        for of_quantity, of_price in zip(statistics.quantity_range(), statistics.price_range(), strict=True)
    )
    return rounded(statistics.fit_line(fits, first, last))


def _bins_sql(name: str, x: str, y: str, x_width: int, y_width: int) -> str:
    return f"""SELECT '{name}' AS fit, product_name,
        CAST(floor(CAST({x} AS DOUBLE) / {x_width}) * {x_width} AS BIGINT) AS x_bin,
        CAST(floor(CAST({y} AS DOUBLE) / {y_width}) * {y_width} AS BIGINT) AS y_bin,
        count(*) AS points FROM {{fact}} GROUP BY ALL"""


_BINS = {"quantity_gross": (1, 1000), "price_tax": (10, 100)}


@query(
    "scatter_sample",
    "\nUNION ALL ".join(_bins_sql(n, *_FITS[n], *widths) for n, widths in _BINS.items()),
)
def scatter_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both scatter plots as counts per product and grid cell; no point is dropped."""
    grids = {name: (*_FITS[name], *widths) for name, widths in _BINS.items()}
    return statistics.scatter_grids(fact(spark, sf_dir), grids)


# Fixed value: points of each product in the sample.
_POINTS = 100


@query(
    "scatter_points",
    f"""SELECT product_name, transaction_id, customer_id, product_id, transaction_date, quantity, gross_amount,
        CAST(CAST(unit_price AS DECIMAL(28,10)) AS VARCHAR) AS unit_price,
        CAST(CAST(tax AS DECIMAL(28,10)) AS VARCHAR) AS tax FROM {{fact}}
        QUALIFY row_number() OVER (PARTITION BY product_name ORDER BY md5(concat_ws('|', transaction_id,
            coalesce(CAST(customer_id AS VARCHAR), ''), coalesce(CAST(product_id AS VARCHAR), ''),
            transaction_date, quantity)), quantity, gross_amount, unit_price, tax) <= {_POINTS}""",
)
def scatter_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of both plots themselves; samples of three parts, merged."""
    rows = fact(spark, sf_dir)
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    rows = materialize(rows, "fact")
    samples = [statistics.scatter_points(rows.where(part == k), _POINTS) for k in range(3)]
    merged = statistics.scatter_points(samples[0].unionByName(samples[1]).unionByName(samples[2]), _POINTS)
    return merged.withColumns({c: F.col(c).cast("string") for c in ("unit_price", "tax")})


# The product names of the test rows; SQL has to name its columns.
_PRODUCT_NAMES = ("Product A", "Product B", "Product C", "Product D", "Product E", "Product F")


@query(
    "customer_product_pivot",
    "SELECT customer_id, "
    + ", ".join(
        f"CAST(coalesce(sum(total_transactions) FILTER (product_name = '{n}'), 0) AS BIGINT)"
        f' AS "{n}"'
        for n in _PRODUCT_NAMES
    )
    + " FROM {agg_by_customer_product} GROUP BY customer_id",
)
def customer_product_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = marts.agg_by_customer_product(fact(spark, sf_dir))
    return statistics.customer_product_pivot(pairs)


@query(
    "customer_product_sparse",
    """SELECT customer_id, string_agg(name_no, ',' ORDER BY name_no) AS name_nos,
        string_agg(n, ',' ORDER BY name_no) AS transactions
        FROM (SELECT customer_id, name_no, CAST(sum(total_transactions) AS BIGINT) AS n
              FROM {agg_by_customer_product} AS p
              JOIN (SELECT name, row_number() OVER (ORDER BY name) - 1 AS name_no
                    FROM (SELECT DISTINCT product_name AS name FROM {agg_by_customer_product}) AS d) AS names
              ON p.product_name = name GROUP BY customer_id, name_no) AS cells
        GROUP BY customer_id""",
)
def customer_product_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = materialize(marts.agg_by_customer_product(fact(spark, sf_dir)), "pairs")
    sparse = statistics.customer_product_sparse(pairs, materialize(statistics.numbered_names(pairs), "numbered"))
    return sparse.select("customer_id", *[F.array_join(c, ",").alias(c) for c in ("name_nos", "transactions")])


@query(
    "daily_activity",
    """SELECT transaction_date, count(transaction_id) AS transactions,
       CAST(sum(total_amount) AS DECIMAL(38,2)) AS revenue FROM {fact} GROUP BY transaction_date""",
)
def daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.daily_activity(fact(spark, sf_dir))


@query(
    "monthly_activity",
    """SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month,
       count(transaction_id) AS transactions,
       CAST(sum(total_amount) AS DECIMAL(38,2)) AS revenue FROM {fact} GROUP BY 1""",
)
def monthly_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.monthly_activity(fact(spark, sf_dir))


@query(
    "kpi_summary",
    f"""SELECT count(*) AS valid_transactions, count(DISTINCT customer_id) AS unique_customers,
        count(DISTINCT product_name) AS unique_products, min(transaction_date) AS first_date,
        max(transaction_date) AS last_date,
        CAST(sum(total_amount) AS DECIMAL(38,2)) AS total_revenue,
        CAST(round(sum(tax), 2) AS DECIMAL(38,2)) AS total_tax,
        {_rounded_sql("CAST(sum(total_amount) AS DOUBLE) / count(total_amount)")}
            AS avg_order_value,
        {_rounded_sql("CAST(sum(tax_rate_pct) AS DOUBLE) / count(tax_rate_pct)")} AS avg_tax_rate
        FROM {{fact}}""",
)
def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(statistics.kpi_summary(fact(spark, sf_dir)))
