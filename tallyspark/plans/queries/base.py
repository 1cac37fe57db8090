"""Registry, the layers all queries share, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspark.operators import landing, marts
from tallyspark.operators.staging import stage_transactions
from tallyspark.plans.queries.derived import (
    DERIVED_POSITION,
    order_lines,
    raw_texts,
    raw_transactions,
    transaction_id,
)
from tallyspark.session import materialize

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the names defined in ``_LAYERS``."""

    def register(function: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        _QUERIES[name] = function
        if sql is not None:
            _SQL[name] = sql
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: with_layers(sql) for name, sql in _SQL.items()}


def sql_over_views(name: str) -> str:
    """The SQL side of a query or layer, its layers being views of their names."""
    sql = _LAYERS[name][1] if name in _LAYERS else _SQL[name]
    for layer in _LAYERS:
        sql = sql.replace("{" + layer + "}", layer)
    return sql


# --- layers -------------------------------------------------------------------


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_transactions(spark, sf_dir)


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of each id: they win as numbers with their id and become text behind the shuffle."""
    lines = order_lines(spark, sf_dir).withColumn(landing.ID, transaction_id())
    return raw_texts(landing.first_wins(lines, DERIVED_POSITION)).drop(*DERIVED_POSITION)


def staged(spark: SparkSession, sf_dir: str, write: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """Cleaned rows over the written landing, as in a daily run; ``write`` may be that of a ``Scratch``.

    Over the window itself the cleaners would run twice, in the filter that meets the rank
    limit and in the projection above it, in one stage too long to be compiled.
    """
    return stage_transactions(write(landed(spark, sf_dir), "landed"))


def fact(spark: SparkSession, sf_dir: str, write: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    return marts.fact_transactions(staged(spark, sf_dir, write))


# --- the same layers in SQL ---------------------------------------------------

_POSITION = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, "
    "l_extendedprice, l_tax"
)


def _members(column: str) -> str:
    """Sorted distinct values as text, NULL last."""
    return (
        f"array_to_string(list_transform(list_sort(list(DISTINCT {column})"
        f" FILTER ({column} IS NOT NULL)), lambda x: CAST(x AS VARCHAR))"
        f" || CASE WHEN count(*) FILTER ({column} IS NULL) > 0 THEN ['NULL'] ELSE [] END, ',')"
    )


def whole_number(column: str) -> str:
    """A decimal of 12 digits behind the point as the whole number of its digits.

    The type is wider than the engine's, so that digits the engine lost would show.
    """
    return f"CAST(replace(CAST({column} AS VARCHAR), '.', '') AS HUGEINT)"


def mean_cents(column: str) -> str:
    """Exact mean of an amount, rounded half up to two digits.

    Whole-number arithmetic: a floating-point quotient misses exact halves.
    """
    total, n = f"sum({whole_number(column)})", f"count({column})"
    cents = f"(2 * CAST({total} AS HUGEINT) + {n} * 10000000000) // (2 * {n} * 10000000000)"
    return f"CAST(CAST({cents} AS DECIMAL(30,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(38,2))"


def _measures(units: str) -> str:
    return f"""count(DISTINCT transaction_id) AS total_transactions,
        min(transaction_date) AS first_transaction_date,
        max(transaction_date) AS last_transaction_date,
        CAST(sum(quantity) AS BIGINT) AS {units},
        CAST(round(sum(total_amount), 2) AS DECIMAL(38,2)) AS total_paid,
        CAST(round(sum(tax), 2) AS DECIMAL(38,2)) AS total_taxes"""


# Tax per gross in percent, rounded half up to four digits, in whole numbers.
_GROSS = f"nullif({whole_number('price')} * quantity, 0)"
_RATE = f"""CAST(CAST((2 * {whole_number('tax')} * 1000000 + {_GROSS}) // (2 * {_GROSS})
        AS DECIMAL(25,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(29,4))"""

# The fields whose absence makes a row count as one with errors.
_ANY_ERROR = """transaction_id IS NULL OR customer_id IS NULL OR transaction_date IS NULL
        OR quantity IS NULL OR price IS NULL OR tax IS NULL"""

# Fixed values below: the column names of every table, which both sides share.
# name -> (layers it reads, query)
# Amounts are 12-digit decimals on this side, wider than the engine's.
_AMOUNT = "DECIMAL(28,12)"


def _raw_sql() -> str:
    return (
        rf"""SELECT
        CASE WHEN k % 41 = 0 THEN NULL WHEN k % 197 = 0 THEN '' WHEN k % 199 = 0 THEN 't' || k
             WHEN l_partkey % 5 = 0 THEN CAST(k AS VARCHAR) ELSE 'T' || k END AS transaction_id,
        CASE WHEN k % 29 <> 0 THEN o_custkey || '.0' END AS customer_id,
        CASE WHEN k % 37 = 0 THEN NULL WHEN k % 31 = 0 THEN '2023/07/15'
             WHEN k % 179 = 0 THEN '31-02-2023'
             WHEN k % 181 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || chr(8232)
             WHEN k % 3 = 0 THEN strftime(o_orderdate, '%d-%m-%Y')
             ELSE strftime(o_orderdate, '%Y-%m-%d') END AS transaction_date,
        CASE WHEN k % 61 <> 0 THEN 'P' || l_partkey END AS product_id,
        'Product ' || substr('ABCDEF', CAST(l_partkey % 6 + 1 AS INTEGER), 1) AS product_name,
        CASE WHEN k % 43 = 0 THEN NULL WHEN k % 47 = 0 THEN '2.5' WHEN k % 53 = 0 THEN 'few'
             ELSE CAST(l_quantity AS INTEGER) || '.0' END AS quantity,
        CASE WHEN k % 23 = 0 THEN 'Two Hundred' WHEN k % 59 = 0 THEN '0'
             WHEN k % 211 = 0 THEN '123456789012345.25'
             WHEN k % 223 = 0 THEN '1.0000004' WHEN k % 227 = 0 THEN '33.1234567891'
             ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
        CASE WHEN k % 19 = 0 THEN 'Fifteen' WHEN k % 229 = 0 THEN '1.0050000049'
             ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                  * CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS VARCHAR) END AS tax,
        CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS loaded_at,
        """
        + _POSITION
        + """
        FROM (SELECT *, l_orderkey * 10 + l_linenumber AS k FROM lineitem)
        JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey"""
    )


_PLAIN_NUMBER = r"regexp_full_match({c}, '\d+(\.\d+)?')"

# The cleaners, by column of the raw layer.
CLEANER_SQL = {
    "transaction_id": "TRY_CAST(nullif(regexp_replace(transaction_id, '^T', ''), '') AS INTEGER)",
    "customer_id": "TRY_CAST(split_part(customer_id, '.', 1) AS INTEGER)",
    "transaction_date": r"""CASE
        WHEN regexp_full_match(transaction_date, '\d{2}-\d{2}-\d{4}')
        THEN CAST(try_strptime(transaction_date, '%d-%m-%Y') AS DATE)
        WHEN regexp_full_match(transaction_date, '\d{4}-\d{2}-\d{2}')
        THEN CAST(try_strptime(transaction_date, '%Y-%m-%d') AS DATE) END""",
    "product_id": "TRY_CAST(nullif(regexp_replace(product_id, '^P', ''), '') AS INTEGER)",
    "product_name": "product_name",
    "quantity": f"CASE WHEN {_PLAIN_NUMBER.replace('{c}', 'quantity')}"
    " THEN TRY_CAST(round(CAST(quantity AS DECIMAL(20,6)), 0) AS INTEGER) END",
    "price": f"CASE WHEN {_PLAIN_NUMBER.replace('{c}', 'price')} THEN CAST(price AS {_AMOUNT}) END",
    "tax": f"CASE WHEN {_PLAIN_NUMBER.replace('{c}', 'tax')} THEN CAST(tax AS {_AMOUNT}) END",
}

# name -> (layers it reads, query)
_LAYERS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw": ((), _raw_sql()),
    "landed": (
        ("raw",),
        f"""SELECT transaction_id, customer_id, transaction_date, product_id, product_name,
        quantity, price, tax, loaded_at
        FROM raw
        QUALIFY transaction_id IS NULL
             OR row_number() OVER (PARTITION BY transaction_id ORDER BY {_POSITION}) = 1""",
    ),
    "staged": (
        ("landed",),
        "SELECT *, transaction_id IS NOT NULL AND customer_id IS NOT NULL"
        " AND transaction_date IS NOT NULL AS is_valid FROM (SELECT "
        + ", ".join(f"{sql} AS {column}" for column, sql in CLEANER_SQL.items())
        + ", loaded_at FROM landed)",
    ),
    "fact": (
        ("staged",),
        f"""SELECT transaction_id, customer_id, product_id, product_name, transaction_date, quantity,
        price AS unit_price, tax,
        CAST(round(price * quantity, 2) AS DECIMAL(38,2)) AS gross_amount,
        CAST(round(price * quantity + tax, 2) AS DECIMAL(38,2)) AS total_amount,
        {_RATE} AS tax_rate_pct,
        loaded_at
        FROM staged
        WHERE is_valid AND price IS NOT NULL AND quantity IS NOT NULL AND tax IS NOT NULL""",
    ),
    "dim_customers": (
        ("staged",),
        f"""SELECT customer_id,
        min(transaction_date) AS first_transaction_date,
        max(transaction_date) AS last_transaction_date,
        count(DISTINCT transaction_id) AS total_transactions,
        count(DISTINCT product_id) AS distinct_products_purchased,
        CAST(round(sum(price * quantity), 2) AS DECIMAL(38,2)) AS total_gross_amount,
        CAST(round(sum(tax), 2) AS DECIMAL(38,2)) AS total_tax_paid,
        CAST(round(sum(price * quantity + tax), 2) AS DECIMAL(38,2)) AS total_amount_incl_tax,
        {mean_cents("price")} AS avg_unit_price
        FROM staged
        WHERE is_valid AND price IS NOT NULL AND quantity IS NOT NULL
        GROUP BY customer_id""",
    ),
    "agg_by_customer": (
        ("fact",),
        f"""SELECT customer_id, {_measures("total_products")},
        {_members("product_id")} AS product_ids,
        count(DISTINCT product_id) AS count_different_products
        FROM fact GROUP BY customer_id""",
    ),
    "agg_by_product": (
        ("fact",),
        f"""SELECT product_id, product_name, {_measures("total_products")},
        {_members("customer_id")} AS customer_ids,
        count(DISTINCT customer_id) AS count_different_customers
        FROM fact GROUP BY product_id, product_name""",
    ),
    "agg_by_customer_product": (
        ("fact",),
        f"""SELECT customer_id, product_id, product_name, {_measures("total_quantity")}
        FROM fact GROUP BY customer_id, product_id, product_name""",
    ),
    "errors_by_customer": (
        ("staged",),
        f"""SELECT coalesce(CAST(customer_id AS VARCHAR), 'NULL') AS customer_id,
        count(*) AS total_rows,
        count(*) FILTER (transaction_id IS NULL) AS null_transaction_id,
        count(*) FILTER (transaction_date IS NULL) AS null_transaction_date,
        count(*) FILTER (quantity IS NULL) AS null_quantity,
        count(*) FILTER (price IS NULL) AS null_price,
        count(*) FILTER (tax IS NULL) AS null_tax,
        count(*) FILTER ({_ANY_ERROR}) AS total_rows_with_errors
        FROM staged GROUP BY staged.customer_id""",
    ),
    "errors_by_load_date": (
        ("staged",),
        f"""SELECT CAST(loaded_at AS DATE) AS load_date, count(*) AS total_rows,
        count(*) FILTER (transaction_id IS NULL) AS null_transaction_id,
        count(*) FILTER (customer_id IS NULL) AS null_customer_id,
        count(*) FILTER (transaction_date IS NULL) AS null_transaction_date,
        count(*) FILTER (quantity IS NULL) AS null_quantity,
        count(*) FILTER (price IS NULL) AS null_price,
        count(*) FILTER (tax IS NULL) AS null_tax,
        count(*) FILTER ({_ANY_ERROR}) AS total_rows_with_errors
        FROM staged GROUP BY CAST(loaded_at AS DATE)""",
    ),
    "dim_products": (
        ("fact",),
        """SELECT product_id, product_name FROM fact WHERE product_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY product_id
            ORDER BY transaction_date DESC, transaction_id DESC, product_name DESC) = 1""",
    ),
    "dim_date": (
        ("fact",),
        """SELECT date_id, CAST(day(date_id) AS INTEGER) AS day,
        CAST(month(date_id) AS INTEGER) AS month, monthname(date_id) AS month_name,
        CAST(quarter(date_id) AS INTEGER) AS quarter, CAST(year(date_id) AS INTEGER) AS year,
        dayname(date_id) AS day_of_week, isodow(date_id) >= 6 AS is_weekend,
        last_day(date_id) = date_id AS is_month_end,
        last_day(date_id) = date_id AND month(date_id) % 3 = 0 AS is_quarter_end
        FROM (SELECT CAST(unnest(generate_series(CAST(min(transaction_date) AS TIMESTAMP),
              CAST(max(transaction_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_id
              FROM fact)""",
    ),
}


def with_layers(sql: str) -> str:
    """Prepend the layers that ``sql`` names in braces, in dependency order."""
    needed: list[str] = []

    def need(name: str) -> None:
        reads, _ = _LAYERS[name]
        for other in reads:
            need(other)
        if name not in needed:
            needed.append(name)

    for name in _LAYERS:
        if "{" + name + "}" in sql:
            need(name)
            sql = sql.replace("{" + name + "}", name)
    if not needed:
        return sql
    # Several readers share one evaluation.
    parts = [f"{name} AS MATERIALIZED ({_LAYERS[name][1]})" for name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + sql
