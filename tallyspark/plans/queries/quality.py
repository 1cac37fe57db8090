"""Declarative checks over the derived tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import marts, quality
from tallyspark.plans.queries.base import fact, query, staged
from tallyspark.session import Scratch, materialize, side_by_side

_FACT_CHECKS = quality.SUITE["fact_transactions"]

# Table of the suite -> layer of the SQL side.
_SQL_LAYER = {name: name for name in quality.SUITE} | {
    "stg_customer_transactions": "staged",
    "fact_transactions": "fact",
}


def suite_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The checked tables, written once each: every check reads its table again."""
    with Scratch(spark) as scratch:
        staging = materialize(staged(spark, sf_dir, scratch.materialize), "staged")
    facts = materialize(marts.fact_transactions(staging), "fact")
    derived = {
        "dim_customers": marts.dim_customers(staging),
        "agg_by_customer": marts.agg_by_customer(facts),
        "agg_by_customer_product": marts.agg_by_customer_product(facts),
        "agg_by_product": marts.agg_by_product(facts),
    }
    written = side_by_side(partial(materialize, df, name) for name, df in derived.items())
    return {
        "stg_customer_transactions": staging,
        "fact_transactions": facts,
        **dict(zip(derived, written, strict=True)),
    }


def _suite_sql() -> str:
    rows = []

    def check(table: str, column: str, test: str, failures: str) -> None:
        rows.append(
            f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test_name,"
            f" CAST(({failures}) AS BIGINT) AS failures"
        )

    for table, checks in quality.SUITE.items():
        source = "{" + _SQL_LAYER[table] + "}"
        for c in checks.not_null:
            check(table, c, "not_null", f"SELECT count(*) FROM {source} WHERE {c} IS NULL")
        for c in checks.unique:
            repeated = f"SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}"
            check(
                table, c, "unique", f"SELECT count(*) FROM ({repeated} HAVING count(*) > 1) AS d"
            )
        for c, accepted in checks.accepted_values.items():
            listed = ", ".join(f"'{v}'" for v in accepted)
            wrong = f"SELECT count(DISTINCT {c}) FROM {source} WHERE {c} NOT IN ({listed})"
            check(table, c, "accepted_values", wrong)
        for c, (parent, key) in checks.relationships.items():
            known = f"SELECT {key} FROM {{{_SQL_LAYER[parent]}}}"
            lost = f"SELECT count(*) FROM {source} WHERE {c} IS NOT NULL AND {c} NOT IN ({known})"
            check(table, c, "relationships", lost)
    return "SELECT *, failures = 0 AS passed FROM (" + "\nUNION ALL ".join(rows) + ") AS report"


@query(
    "dq_unique",
    """SELECT transaction_id, count(*) AS occurrences FROM {fact}
       GROUP BY transaction_id HAVING count(*) > 1""",
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicated_values(fact(spark, sf_dir), "transaction_id")


@query(
    "dq_not_null",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS failures FROM {{fact}}"
        for c in _FACT_CHECKS.not_null
    ),
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(fact(spark, sf_dir), _FACT_CHECKS.not_null)


# The dimension as it stood before this load misses the customers who came later.
_DIMENSION_AS_OF = "1992-04-01 00:00:00"


@query(
    "dq_relationships",
    f"""SELECT customer_id, count(*) AS child_rows FROM {{fact}}
       WHERE customer_id NOT IN (
           SELECT customer_id FROM {{staged}}
           WHERE is_valid AND price IS NOT NULL AND quantity IS NOT NULL
             AND loaded_at < TIMESTAMP '{_DIMENSION_AS_OF}')
       GROUP BY customer_id""",
)
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared relationship, fact to ``dim_customers``, over a dimension that was not rebuilt.

    Over tables of one run it holds by construction, which the suite checks.
    """
    staging = staged(spark, sf_dir)
    before = F.col("loaded_at") < F.lit(_DIMENSION_AS_OF).cast("timestamp_ntz")
    parent = marts.dim_customers(staging.where(before))
    return quality.orphans(marts.fact_transactions(staging), "customer_id", parent, "customer_id")


@query(
    "dq_accepted_values",
    """SELECT product_name, count(*) AS occurrences FROM {fact}
       WHERE product_name NOT IN ('Product A', 'Product B', 'Product C', 'Product D', 'Product E')
       GROUP BY product_name""",
)
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unaccepted_values(
        fact(spark, sf_dir), "product_name", _FACT_CHECKS.accepted_values["product_name"]
    )


@query("dq_suite", _suite_sql())
def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_suite(suite_tables(spark, sf_dir))


@query(
    "dq_gate",
    f"SELECT table_name, column_name, test_name, failures FROM ({_suite_sql()}) AS s"
    " WHERE NOT passed",
)
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks on which the gate stops a run."""
    report = quality.run_suite(suite_tables(spark, sf_dir))
    return report.where(~F.col("passed")).select(*quality.REPORT)
