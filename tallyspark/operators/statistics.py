"""Exploratory statistics over the fact table and the marts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.student_t import correlation_p_value
from tallyspark.operators import moments
from tallyspark.operators.quantiles import (
    QUARTILE_NAMES,
    bucket_of,
    interpolate,
    locate,
    present,
    quantiles_of,
    value_counts,
)
from tallyspark.schemas import FACT_MEASURES, MONEY
from tallyspark.session import materialize


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionAll(other)
    return result


def mart_row_counts(fact: DataFrame) -> DataFrame:
    """Rows of the fact and of the marts it gives, in one pass; a NULL key is a row too."""
    customer, product = F.struct("customer_id"), F.struct("product_id", "product_name")
    counts = {
        "fact_transactions": F.count(F.lit(1)),
        "agg_by_customer": F.count_distinct(customer),
        "agg_by_product": F.count_distinct(product),
    }
    totals = fact.agg(*[count.alias(name) for name, count in counts.items()])
    return totals.unpivot([], list(counts), "table_name", "row_count")


def measure_values(fact: DataFrame, columns: Sequence[str] = FACT_MEASURES) -> DataFrame:
    """(column_name, value): the measures below one another."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
            for c in columns
        ]
    )
    return fact.select(F.inline(pairs))


def describe_numeric(fact: DataFrame, columns: Sequence[str] = FACT_MEASURES) -> DataFrame:
    """Per column: count, mean, sample deviation, extremes, exact quartiles.

    Reads the fact twice and shuffles only bucket totals: the first pass merges
    moments per bucket, the second counts single values in the few buckets that
    hold a quartile. Those are at most two per column and quartile, so they are
    broadcast whatever the size of the fact.
    """
    values = present(measure_values(fact, columns), "column_name")
    totals = values.groupBy("column_name", "bucket").agg(
        F.count(F.lit(1)).alias("in_bucket"),
        F.avg("value").alias("bucket_mean"),
        F.var_pop("value").alias("bucket_variance"),
        F.min("value").alias("bucket_min"),
        F.max("value").alias("bucket_max"),
    )

    def read(chosen: DataFrame) -> DataFrame:
        hits = values.join(F.broadcast(chosen), ["column_name", "bucket"])
        return hits.groupBy(*chosen.columns, "value").agg(F.count(F.lit(1)).alias("n"))

    return described(totals, read)


def described(totals: DataFrame, read: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The description from moments per column and bucket; ``read`` joins value counts to buckets."""
    whole = Window.partitionBy("column_name")
    off = F.col("bucket_mean") - F.col("mean")
    known = (
        totals.withColumn(
            "mean",
            F.sum(F.col("in_bucket") * F.col("bucket_mean")).over(whole)
            / F.sum("in_bucket").over(whole),
        )
        .withColumn(
            "squares",
            F.sum(F.col("in_bucket") * (F.col("bucket_variance") + off * off)).over(whole),
        )
        .withColumn("min", F.min("bucket_min").over(whole))
        .withColumn("max", F.max("bucket_max").over(whole))
    )
    carried = ["all_rows", "mean", "squares", "min", "max"]
    chosen = locate(known, "column_name").select("column_name", "bucket", "before", *carried)
    return interpolate(read(chosen), "column_name", carry=carried).select(
        "column_name",
        F.col("all_rows").alias("count"),
        "mean",
        F.sqrt(F.try_divide(F.col("squares"), F.col("all_rows") - 1)).alias("std"),
        "min",
        *QUARTILE_NAMES,
        "max",
    )


def _unit_range(r: Column) -> Column:
    """Cut off what rounding puts beyond -1 or 1; ``least`` alone would skip NULL."""
    return F.when(r > 1, F.lit(1.0)).when(r < -1, F.lit(-1.0)).otherwise(r)


def _pearson(x: Column, y: Column) -> Column:
    """r over rows where both are present; NULL for a constant column."""
    scale = F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x))
    return _unit_range(F.regr_sxy(y, x) / F.nullif(scale, F.lit(0.0)))


def correlation_matrix(fact: DataFrame, columns: Sequence[str] = FACT_MEASURES) -> DataFrame:
    """(column_a, column_b, r) for every ordered pair, from one pass.

    Integers and decimals are added up exactly. Floating-point columns take Spark's own
    sums, with one record per column and row, which keeps the aggregate narrow enough for
    generated code.
    """
    if moments.is_exact(fact, columns):
        pairs = {f"{a} {b}": (a, b) for a in columns for b in columns}
        return moments.pair_fits(fact, pairs).select(
            F.col("x").alias("column_a"), F.col("y").alias("column_b"), "r"
        )
    as_double = [F.col(c).cast("double").alias(c) for c in columns]
    records = F.array(
        *[F.struct(F.lit(c).alias("column_a"), F.col(c).alias("paired_with")) for c in columns]
    )
    matrix = (
        fact.select(*as_double)
        .select(F.inline(records), *columns)
        .groupBy("column_a")
        .agg(*[_pearson(F.col("paired_with"), F.col(c)).alias(c) for c in columns])
    )
    return matrix.unpivot("column_a", list(columns), "column_b", "r")


def boxplot_stats(fact: DataFrame, value: str = "unit_price") -> DataFrame:
    """Per product name: quartiles, whiskers at the last value within 1.5 IQR, outliers.

    Nothing but the quartiles is keyed by product alone. The reach of the
    whiskers is looked up among the bucket totals, and value by value only in
    the two buckets where it ends.
    """
    group = "product_name"
    counts = value_counts(fact, group, value)
    totals = counts.groupBy(group, "bucket").agg(
        F.sum("n").alias("in_bucket"), F.min("value").alias("bucket_min"), F.max("value").alias("bucket_max")
    )
    return boxplots(totals, lambda wanted: counts.join(wanted, [group, "bucket"]), group)


def boxplots(totals: DataFrame, read: Callable[[DataFrame], DataFrame], group: str) -> DataFrame:
    """Box plots from bucket totals; ``read`` joins value counts to wanted buckets."""
    reach = (F.col("q75") - F.col("q25")) * 1.5
    limits = (
        quantiles_of(totals, read, group)
        .withColumn("low", F.col("q25") - reach)
        .withColumn("high", F.col("q75") + reach)
        .withColumn("low_bucket", bucket_of(F.col("low")))
        .withColumn("high_bucket", bucket_of(F.col("high")))
    )
    keys = [group, *QUARTILE_NAMES]
    between = (F.col("bucket") > F.col("low_bucket")) & (F.col("bucket") < F.col("high_bucket"))
    inner = totals.join(limits, group).select(
        *keys,
        F.col("in_bucket").alias("rows"),
        F.when(between, F.col("in_bucket")).otherwise(0).alias("inside"),
        F.when(between, F.col("bucket_min")).alias("lowest"),
        F.when(between, F.col("bucket_max")).alias("highest"),
    )
    end_buckets = F.array_distinct(F.array("low_bucket", "high_bucket"))
    ends = limits.select(*keys, "low", "high", F.explode(end_buckets).alias("bucket"))
    edge = (
        read(ends)
        .where(F.col("value").between(F.col("low"), F.col("high")))
        .select(
            *keys,
            F.lit(0).cast("bigint").alias("rows"),
            F.col("n").alias("inside"),
            F.col("value").alias("lowest"),
            F.col("value").alias("highest"),
        )
    )
    return (
        inner.unionAll(edge)
        .groupBy(*keys)
        .agg(
            F.sum("rows").alias("count"),
            F.least(F.min("lowest"), F.col("q25")).alias("whisker_low"),
            F.greatest(F.max("highest"), F.col("q75")).alias("whisker_high"),
            (F.sum("rows") - F.sum("inside")).alias("outliers"),
        )
        .select(group, "count", *QUARTILE_NAMES, "whisker_low", "whisker_high", "outliers")
    )


def linear_fits(fact: DataFrame, fits: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row for each named fit (x, y), all from one pass over the fact.

    Least squares of y on x, Pearson r, rows used, range of x; r is 0 where y is constant.
    Exact for integers and decimals.
    """
    if moments.is_exact(fact, [c for pair in fits.values() for c in pair]):
        r = F.when(F.col("slope").isNotNull(), F.coalesce("r", F.lit(0.0)))
        return moments.pair_fits(fact, fits).select(
            "fit", "slope", "intercept", r.alias("r"), "n", "min_x", "max_x"
        )
    sums, rows = [], []
    for k, (name, (x, y)) in enumerate(fits.items()):
        cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
        both = F.when(cy.isNotNull(), cx)
        parts = {
            "sxx": F.regr_sxx(cy, cx),
            "syy": F.regr_syy(cy, cx),
            "sxy": F.regr_sxy(cy, cx),
            "mean_x": F.regr_avgx(cy, cx),
            "mean_y": F.regr_avgy(cy, cx),
            "n": F.regr_count(cy, cx),
            "min_x": F.min(both),
            "max_x": F.max(both),
        }
        sums += [part.alias(f"{part_name}_{k}") for part_name, part in parts.items()]
        rows.append(
            F.struct(F.lit(name).alias("fit"), *[F.col(f"{p}_{k}").alias(p) for p in parts])
        )
    slope = F.col("sxy") / F.nullif(F.col("sxx"), F.lit(0.0))
    r = F.when(F.col("syy") == 0, F.lit(0.0)).otherwise(
        F.col("sxy") / F.nullif(F.sqrt(F.col("sxx") * F.col("syy")), F.lit(0.0))
    )
    return (
        fact.agg(*sums)
        .select(F.inline(F.array(*rows)))
        .select(
            "fit",
            slope.alias("slope"),
            (F.col("mean_y") - slope * F.col("mean_x")).alias("intercept"),
            F.when(F.col("sxx") != 0, _unit_range(r)).alias("r"),
            "n",
            "min_x",
            "max_x",
        )
    )


def linear_fit(fact: DataFrame, x: str, y: str) -> DataFrame:
    """One row: the fit of y on x."""
    return linear_fits(fact, {"": (x, y)}).drop("fit")


def with_p_value(fit: DataFrame) -> DataFrame:
    """Add the two-sided p-value to one-row fits; Spark has no t distribution."""

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            values = [
                correlation_p_value(None if pd.isna(r) else float(r), int(n))
                for r, n in zip(rows["r"], rows["n"])
            ]
            yield rows.assign(p_value=pd.Series(values, dtype="float64", index=rows.index))

    schema = T.StructType([*fit.schema.fields, T.StructField("p_value", T.DoubleType())])
    return fit.mapInPandas(finish, schema)


# Fixed value: a line has at most one more point than this.
LINE_POINTS = 20_000


def fit_line(fit: DataFrame, first: Column, last: Column) -> DataFrame:
    """Points (fit, x, y) at whole x from first to last, both included.

    Empty if last < first. A range of more than ``LINE_POINTS`` is drawn in equal steps, so
    that a line stays as short as that, however far its ends are apart.
    """
    name = ["fit"] if "fit" in fit.columns else []
    bounds = fit.select(*name, "slope", "intercept", first.alias("lo"), last.alias("hi")).where("hi >= lo")
    step = F.expr(f"(hi - lo) div {LINE_POINTS} + 1")
    drawn = F.array_distinct(F.concat(F.sequence("lo", "hi", step), F.array("hi")))
    points = bounds.withColumn("x", F.explode(drawn))
    return points.select(*name, "x", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y"))


# First and last x: 1 to 5, and whole prices from the smallest up to below the largest.
def quantity_range() -> tuple[Column, Column]:
    return F.lit(1).cast("bigint"), F.lit(5).cast("bigint")


def price_range() -> tuple[Column, Column]:
    return F.col("min_x").cast("bigint"), F.col("max_x").cast("bigint") - 1


def quantity_line(fit: DataFrame) -> DataFrame:
    return fit_line(fit, *quantity_range())


def price_line(fit: DataFrame) -> DataFrame:
    return fit_line(fit, *price_range())


def scatter_grids(fact: DataFrame, grids: Mapping[str, tuple[str, str, int, int]]) -> DataFrame:
    """Points per named grid (x, y, width, height), product and cell, from one pass.

    Every row counts, few rows come out.
    """

    def cell(column: str, width: int) -> Column:
        return (F.floor(F.col(column) / F.lit(width)) * width).cast("bigint")

    cells = [
        F.struct(
            F.lit(name).alias("fit"), cell(x, x_width).alias("x_bin"), cell(y, y_width).alias("y_bin")
        )
        for name, (x, y, x_width, y_width) in grids.items()
    ]
    keys = ["fit", "product_name", "x_bin", "y_bin"]
    return (
        fact.select("product_name", F.inline(F.array(*cells)))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("points"))
    )


def scatter_bins(fact: DataFrame, x: str, y: str, x_width: int, y_width: int) -> DataFrame:
    """One grid of ``scatter_grids``."""
    return scatter_grids(fact, {"": (x, y, x_width, y_width)}).drop("fit")


# Columns of both scatter plots.
POINT_COLUMNS = ("quantity", "gross_amount", "unit_price", "tax")
# Rows that tell one fact row from another in the order of a sample.
_IDENTITY = ("transaction_id", "customer_id", "product_id", "transaction_date", "quantity")


def scatter_points(fact: DataFrame, k: int, columns: Sequence[str] = POINT_COLUMNS) -> DataFrame:
    """(product_name, transaction_id, *columns): k rows of every product, all if there are fewer.

    Those with the smallest hashes of their identity: the same rows on every run and for
    any partitioning. The limit is applied where the rows are read, so that a hot product
    sends k rows a task. Samples of parts merge: the sample of their union is the sample
    of the whole, as ``scatter_points`` of the united samples shows.
    """
    name = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _IDENTITY])
    kept = dict.fromkeys(["product_name", *_IDENTITY, *columns])
    order = Window.partitionBy("product_name").orderBy("__hash", *columns)
    ranked = fact.select(*kept, F.md5(name.cast("binary")).alias("__hash")).withColumn("__rank", F.row_number().over(order))
    return ranked.where(F.col("__rank") <= k).drop("__hash", "__rank")


# Fixed value: the most columns a pivot may have.
MAX_PIVOT_COLUMNS = 10_000


def product_names(agg_cp: DataFrame) -> list[str | None]:
    """The names that occur, sorted, None first if rows have none. One distinct pass over the mart."""
    found = agg_cp.select("product_name").distinct().limit(MAX_PIVOT_COLUMNS + 1).collect()
    names = sorted((row.product_name for row in found), key=lambda name: (name is not None, name or ""))
    if len(names) > MAX_PIVOT_COLUMNS:
        raise ValueError(f"more than {MAX_PIVOT_COLUMNS} product names do not make columns: see customer_product_sparse")
    return names


def customer_product_pivot(
    agg_cp: DataFrame, names: Sequence[str | None] | None = None, on_repeat: str = "sum"
) -> DataFrame:
    """Customers by product names: number of transactions, 0 where there are none.

    The columns are the names that occur; rows without name have the column ``NULL``, or
    ``NULL (missing)`` beside a product of that name. With ``names`` the columns are
    those; a name outside the list then stops the query instead of vanishing. Several
    products may share a name: their counts are added up, or refused with
    ``on_repeat="raise"``. For any number of names there is ``customer_product_sparse``.
    """
    columns = product_names(agg_cp) if names is None else list(names)
    # A letter in front keeps the missing name apart from every other.
    keys = ["-" if name is None else f"+{name}" for name in columns]
    shown = ["NULL (missing)" if "NULL" in columns else "NULL" if name is None else name for name in columns]
    shown = [name if own is None else own for name, own in zip(shown, columns, strict=True)]
    key = F.coalesce(F.concat(F.lit("+"), "product_name"), F.lit("-"))
    listed = F.when(key.isin(*keys), key).otherwise(
        F.raise_error(F.concat(F.lit("unlisted product name: "), F.coalesce("product_name", F.lit("NULL"))))
    )
    cells = F.sum("total_transactions")
    if on_repeat == "raise":
        cells = F.when(
            F.count(F.lit(1)) > 1, F.raise_error(F.lit("several rows for one customer and name"))
        ).otherwise(cells)
    elif on_repeat != "sum":
        raise ValueError(f"unknown on_repeat {on_repeat!r}")
    pivot = (
        agg_cp.select("customer_id", listed.alias("product_name"), "total_transactions")
        .groupBy("customer_id")
        .pivot("product_name", keys)
        .agg(cells)
        .fillna(0)
    )
    return pivot.toDF("customer_id", *shown)


def numbered_names(agg_cp: DataFrame) -> DataFrame:
    """(name_no, product_name) of the names that occur, from 0 in their order, a missing one first.

    Expects a written table. Names are sorted in ranges and counted per range; only the
    counts of ranges meet in one task, so any number of names is numbered.
    """
    names = agg_cp.select("product_name").distinct()
    ranges = names.repartitionByRange(F.col("product_name").asc_nulls_first()).sortWithinPartitions(
        F.col("product_name").asc_nulls_first()
    )
    seq = F.monotonically_increasing_id()
    placed = materialize(
        ranges.select("product_name", F.shiftright(seq, 33).alias("range_no"), seq.bitwiseAND((1 << 33) - 1).alias("place")),
        "names",
    )
    before = F.sum("in_range").over(Window.partitionBy(F.lit(0)).orderBy("range_no")) - F.col("in_range")
    counts = placed.groupBy("range_no").agg(F.count(F.lit(1)).alias("in_range")).select("range_no", before.alias("before"))
    return placed.join(F.broadcast(counts), "range_no").select((F.col("before") + F.col("place")).alias("name_no"), "product_name")


def customer_product_sparse(agg_cp: DataFrame, names: DataFrame) -> DataFrame:
    """(customer_id, name_nos, transactions): the pivot's cells that are not empty, one row a customer.

    Arrays of the numbers of the names, sorted, and of the transactions at the same
    places, as sparse vectors have them. Names never pass the driver, and a row is as
    long as the customer has names.
    """
    numbers = names.select("name_no", F.col("product_name").alias("__name"))
    cells = (
        agg_cp.groupBy("customer_id", "product_name")
        .agg(F.sum("total_transactions").alias("n"))
        .join(numbers, F.col("product_name").eqNullSafe(F.col("__name")))
    )
    entries = F.sort_array(F.collect_list(F.struct("name_no", "n")))
    return cells.groupBy("customer_id").agg(entries.alias("e")).select(
        "customer_id", F.col("e.name_no").alias("name_nos"), F.col("e.n").alias("transactions")
    )


def _activity(fact: DataFrame, day: Column, name: str) -> DataFrame:
    return fact.groupBy(day.alias(name)).agg(
        F.count("transaction_id").alias("transactions"),
        F.sum("total_amount").cast(MONEY).alias("revenue"),
    )


def daily_activity(fact: DataFrame) -> DataFrame:
    return _activity(fact, F.col("transaction_date"), "transaction_date")


def monthly_activity(fact: DataFrame) -> DataFrame:
    return _activity(fact, F.trunc("transaction_date", "month"), "month")


def kpi_summary(fact: DataFrame) -> DataFrame:
    """One row of key figures; missing tax rates do not count towards the mean."""

    def mean(column: str) -> Column:
        total, seen = F.sum(column).cast("double"), F.count(column)
        return F.try_divide(total, seen)

    return fact.agg(
        F.count(F.lit(1)).alias("valid_transactions"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("product_name").alias("unique_products"),
        F.min("transaction_date").alias("first_date"),
        F.max("transaction_date").alias("last_date"),
        F.sum("total_amount").cast(MONEY).alias("total_revenue"),
        F.round(F.sum("tax"), 2).cast(MONEY).alias("total_tax"),
        mean("total_amount").alias("avg_order_value"),
        mean("tax_rate_pct").alias("avg_tax_rate"),
    )
