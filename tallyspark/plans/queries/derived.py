"""Raw transactions derived from the order tables.

Every line item becomes one dirty text row: missing values, prefixes, two date
formats, spelled-out amounts and repeated ids are planted by arithmetic on the
line's key, so the result grows with the tables and is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Order of the rows, unique by the last column.
DERIVED_POSITION = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_quantity",
    "l_extendedprice",
    "l_tax",
    "row_seq",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers that raw rows are made of, with the position columns: narrow rows to shuffle."""
    lines = read_table(spark, sf_dir, "lineitem").withColumn(
        "row_seq", F.monotonically_increasing_id()
    )
    # Dates go through DATE, so that no session time zone can shift them.
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date")
    )
    parts = read_table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_retailprice").cast("decimal(18,2)").alias("part_price"),
    )
    # Parts first: the second shuffle of the lines then carries one number, not two.
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.select(*DERIVED_POSITION, "part_price", "o_custkey", "order_date")


def load_month() -> Column:
    return F.trunc("l_shipdate", "month").cast("timestamp_ntz")


def _key() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def every(n: int) -> Column:
    return _key() % n == 0


def transaction_id() -> Column:
    """The id of a line's raw row."""
    number = _key().cast("string")
    return F.when(
        ~every(41),
        F.when(every(197), F.lit(""))
        .when(every(199), F.concat(F.lit("t"), number))
        .otherwise(F.concat(F.when(F.col("l_partkey") % 5 == 0, "").otherwise("T"), number)),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with their position columns."""
    return raw_texts(order_lines(spark, sf_dir))


def raw_texts(lines: DataFrame, *kept: str) -> DataFrame:
    """A raw row of each line, in the order and the partitions of the lines, with columns to keep."""

    def text(column: Column) -> Column:
        return column.cast("string")

    def money(name: str) -> Column:
        return F.col(name).cast("decimal(18,2)")

    customer_text = F.concat(text(F.col("o_custkey")), F.lit(".0"))
    date_text = text(F.col("order_date"))

    def part_of(start: int, length: int) -> Column:
        return F.substring(date_text, start, length)

    columns = {
        "transaction_id": transaction_id(),
        "customer_id": F.when(~every(29), customer_text),
        "transaction_date": F.when(every(37), None)
        .when(every(31), F.lit("2023/07/15"))
        .when(every(179), F.lit("31-02-2023"))
        .when(every(181), F.concat(date_text, F.lit("\u2028")))
        .when(every(3), F.concat_ws("-", part_of(9, 2), part_of(6, 2), part_of(1, 4)))
        .otherwise(date_text),
        "product_id": F.when(~every(61), F.concat(F.lit("P"), text(F.col("l_partkey")))),
        "product_name": F.concat(
            F.lit("Product "),
            F.substring(F.lit("ABCDEF"), (F.col("l_partkey") % 6 + 1).cast("int"), F.lit(1)),
        ),
        "quantity": F.when(every(43), None)
        .when(every(47), F.lit("2.5"))
        .when(every(53), F.lit("few"))
        .otherwise(F.concat(text(F.col("l_quantity").cast("int")), F.lit(".0"))),
        "price": F.when(every(23), F.lit("Two Hundred"))
        .when(every(59), F.lit("0"))
        .when(every(211), F.lit("123456789012345.25"))
        .when(every(223), F.lit("1.0000004"))
        .when(every(227), F.lit("33.1234567891"))
        .otherwise(text(F.col("part_price"))),
        "tax": F.when(every(19), F.lit("Fifteen"))
        .when(every(229), F.lit("1.0050000049"))
        .otherwise(text((money("l_extendedprice") * money("l_tax")).cast("decimal(18,4)"))),
        "loaded_at": load_month(),
    }
    return lines.select(*[c.alias(n) for n, c in columns.items()], *DERIVED_POSITION, *kept)
