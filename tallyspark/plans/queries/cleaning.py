"""Staging: cleaners one by one, the whole projection, and their functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions import cleaners
from tallyspark.operators import marts
from tallyspark.operators.staging import clean_rows, cleaned_columns, digit_loss, flag_valid
from tallyspark.plans.queries import base
from tallyspark.plans.queries.base import CLEANER_SQL, landed, query, staged
from tallyspark.schemas import MONEY

# --- one cleaner each: raw text, result, rows ---------------------------------

def _per_text(column: str) -> base.Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return (
            landed(spark, sf_dir)
            .groupBy(column)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(
                F.col(column).alias("source_text"),
                cleaned_columns()[column].alias("cleaned"),
                "row_count",
            )
        )

    return run


def _per_text_sql(column: str, cleaned: str) -> str:
    return (
        f"SELECT {column} AS source_text, {cleaned} AS cleaned, count(*) AS row_count"
        f" FROM {{landed}} GROUP BY {column}"
    )


for _column in CLEANER_SQL:
    _name = "pass_product_name" if _column == "product_name" else f"clean_{_column}"
    query(_name, _per_text_sql(_column, CLEANER_SQL[_column]))(_per_text(_column))


# --- whole projection and predicates ------------------------------------------


@query("stage_transactions", "SELECT * FROM {staged}")
def stage_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir)


@query(
    "flag_is_valid",
    """SELECT transaction_id IS NULL AS no_id, customer_id IS NULL AS no_customer,
       transaction_date IS NULL AS no_date, is_valid, count(*) AS row_count
       FROM {staged} GROUP BY ALL""",
)
def flag_is_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        staged(spark, sf_dir)
        .groupBy(
            F.col("transaction_id").isNull().alias("no_id"),
            F.col("customer_id").isNull().alias("no_customer"),
            F.col("transaction_date").isNull().alias("no_date"),
            "is_valid",
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query("filter_valid", "SELECT * FROM {staged} WHERE is_valid")
def filter_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.valid_rows(staged(spark, sf_dir))


@query(
    "filter_dim_measures",
    "SELECT * FROM {staged} WHERE is_valid AND price IS NOT NULL AND quantity IS NOT NULL",
)
def filter_dim_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.priced_rows(staged(spark, sf_dir))


@query(
    "filter_fact_measures",
    """SELECT * FROM {staged} WHERE is_valid AND price IS NOT NULL AND quantity IS NOT NULL
       AND tax IS NOT NULL""",
)
def filter_fact_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.measured_rows(staged(spark, sf_dir))


@query(
    "project_rename",
    """SELECT transaction_id, customer_id, product_id, price AS unit_price, tax
       FROM {staged} WHERE is_valid""",
)
def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.valid_rows(staged(spark, sf_dir)).select(
        "transaction_id", "customer_id", "product_id", F.col("price").alias("unit_price"), "tax"
    )


@query(
    "cte_chain",
    """SELECT loaded_at, is_valid, count(*) AS row_count FROM {staged}
       GROUP BY loaded_at, is_valid""",
)
def cte_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source, cleaned rows and validated rows as named steps."""
    source = landed(spark, sf_dir)
    cleaned = clean_rows(source)
    validated = flag_valid(cleaned)
    return validated.groupBy("loaded_at", "is_valid").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "case_when",
    r"""SELECT CASE WHEN transaction_date IS NULL THEN 'missing'
        WHEN regexp_full_match(transaction_date, '\d{2}-\d{2}-\d{4}') THEN 'day first'
        WHEN regexp_full_match(transaction_date, '\d{4}-\d{2}-\d{2}') THEN 'iso' END AS date_shape,
        count(*) AS row_count FROM {landed} GROUP BY 1""",
)
def case_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.col("transaction_date")
    shape = (
        F.when(date.isNull(), "missing")
        .when(cleaners.iso_date_text(date).isNull(), F.lit(None))
        .when(cleaners.is_day_first(date), "day first")
        .otherwise("iso")
    )
    return (
        landed(spark, sf_dir)
        .groupBy(shape.alias("date_shape"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "is_null_predicates",
    """SELECT count(*) FILTER (transaction_id IS NOT NULL AND customer_id IS NOT NULL
              AND transaction_date IS NOT NULL) AS all_present,
       count(*) FILTER (transaction_id IS NULL OR customer_id IS NULL OR transaction_date IS NULL
              OR quantity IS NULL OR price IS NULL OR tax IS NULL) AS any_missing,
       count(*) FILTER (product_id IS NULL) AS no_product FROM {staged}""",
)
def is_null_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = {c: F.col(c).isNull() for c in ("transaction_id", "customer_id", "transaction_date")}
    any_id = missing["transaction_id"] | missing["customer_id"] | missing["transaction_date"]
    any_measure = F.col("quantity").isNull() | F.col("price").isNull() | F.col("tax").isNull()
    return staged(spark, sf_dir).agg(
        F.count_if(~any_id).alias("all_present"),
        F.count_if(any_id | any_measure).alias("any_missing"),
        F.count_if(F.col("product_id").isNull()).alias("no_product"),
    )


@query(
    "numeric_digit_loss",
    r"""SELECT column_name, count(*) FILTER (regexp_full_match(v, '\d+(\.\d+)?')
        AND (length(rtrim(split_part(v, '.', 2), '0')) > 10
             OR length(ltrim(split_part(v, '.', 1), '0')) > 16)) AS values_losing_digits
        FROM (SELECT 'price' AS column_name, price AS v FROM {landed}
              UNION ALL SELECT 'tax', tax FROM {landed}) GROUP BY column_name""",
)
def numeric_digit_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digit_loss(landed(spark, sf_dir))


# --- scalar functions: every distinct text and what the function makes of it ---


def _distinct_texts(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    return landed(spark, sf_dir).select(column).distinct()


def _distinct_sql(column: str, results: str) -> str:
    return f"SELECT DISTINCT {column} AS source_text, {results} FROM {{landed}}"


@query(
    "fn_regexp_strip_prefix",
    _distinct_sql("transaction_id", "regexp_replace(transaction_id, '^T', '') AS stripped"),
)
def fn_regexp_strip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _distinct_texts(spark, sf_dir, "transaction_id").select(
        F.col("transaction_id").alias("source_text"),
        cleaners.strip_prefix(F.col("transaction_id"), "T").alias("stripped"),
    )


@query(
    "fn_ilike",
    _distinct_sql(
        "transaction_id",
        "transaction_id ILIKE 't%' AND regexp_replace(transaction_id, '^T', '') <> transaction_id"
        " AS has_prefix",
    ),
)
def fn_ilike(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix is matched without case but only an upper-case one is cut off.

    A lower-case one stays and cannot be converted, as if there were no prefix.
    """
    return _distinct_texts(spark, sf_dir, "transaction_id").select(
        F.col("transaction_id").alias("source_text"),
        cleaners.has_prefix(F.col("transaction_id"), "T").alias("has_prefix"),
    )


@query("fn_split_part", _distinct_sql("customer_id", "split_part(customer_id, '.', 1) AS whole"))
def fn_split_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _distinct_texts(spark, sf_dir, "customer_id").select(
        F.col("customer_id").alias("source_text"),
        cleaners.before_dot(F.col("customer_id")).alias("whole"),
    )


@query(
    "fn_nullif",
    """SELECT nullif(regexp_replace(transaction_id, '^T', ''), '') IS NULL AS no_id,
       nullif(price * quantity, 0) IS NULL AS no_gross, count(*) AS row_count
       FROM (SELECT transaction_id, CAST(price AS DECIMAL(28,12)) AS price,
             CAST(round(CAST(quantity AS DECIMAL(20,6)), 0) AS INTEGER) AS quantity FROM {landed}
             WHERE regexp_full_match(price, '\\d+(\\.\\d+)?')
               AND regexp_full_match(quantity, '\\d+(\\.\\d+)?'))
       GROUP BY ALL""".replace("\\\\", "\\"),
)
def fn_nullif(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both uses: an id of which nothing is left, and a gross of zero under the tax."""
    rows = landed(spark, sf_dir).select(
        cleaners.id_digits(F.col("transaction_id"), "T").isNull().alias("no_id"),
        cleaned_columns()["price"].alias("price"),
        cleaned_columns()["quantity"].alias("quantity"),
        F.lit(1).cast("decimal(26,10)").alias("tax"),
    )
    return (
        rows.where("price IS NOT NULL AND quantity IS NOT NULL")
        .groupBy("no_id", marts.tax_rate_pct().isNull().alias("no_gross"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "fn_coalesce_text",
    "SELECT DISTINCT coalesce(CAST(customer_id AS VARCHAR), 'NULL') AS customer FROM {staged}",
)
def fn_coalesce_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = F.coalesce(F.col("customer_id").cast("string"), F.lit("NULL"))
    return staged(spark, sf_dir).select(customer.alias("customer")).distinct()


@query(
    "fn_to_date_two_formats",
    _distinct_sql("transaction_date", CLEANER_SQL["transaction_date"] + " AS day"),
)
def fn_to_date_two_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _distinct_texts(spark, sf_dir, "transaction_date").select(
        F.col("transaction_date").alias("source_text"),
        cleaners.clean_date(F.col("transaction_date")).alias("day"),
    )


@query("fn_numeric_guard_cast", _distinct_sql("tax", CLEANER_SQL["tax"] + " AS amount"))
def fn_numeric_guard_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _distinct_texts(spark, sf_dir, "tax").select(
        F.col("tax").alias("source_text"),
        cleaners.clean_amount(F.col("tax"), "tax").alias("amount"),
    )


@query(
    "fn_round_half_up",
    _distinct_sql(
        "tax",
        "CAST(round(" + CLEANER_SQL["tax"] + ", 2) AS DECIMAL(38,2)) AS cents,"
        " CAST(round(-(" + CLEANER_SQL["tax"] + "), 2) AS DECIMAL(38,2)) AS negative_cents",
    ),
)
def fn_round_half_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = cleaners.clean_amount(F.col("tax"), "tax")
    return _distinct_texts(spark, sf_dir, "tax").select(
        F.col("tax").alias("source_text"),
        F.round(amount, 2).cast(MONEY).alias("cents"),
        F.round(-amount, 2).cast(MONEY).alias("negative_cents"),
    )
