"""Reading, landing and storing raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.operators import landing
from tallyspark.plans.daily_run import land
from tallyspark.plans.queries.base import _POSITION, fact, landed, query, raw, staged
from tallyspark.schemas import RAW_COLUMNS, RAW_LIMITS
from tallyspark.session import Scratch, materialize, scratch_path, shuffles_deleted
from tallyspark.sources.csv_source import (
    CORRUPT,
    CSV_WRITE_OPTIONS,
    read_transactions,
    read_with_rejects,
    write_transactions,
)
from tallyspark.plans.queries.derived import DERIVED_POSITION, load_month, order_lines, raw_texts, transaction_id
from tallyspark.sources.tables import Warehouse
from tallyspark.streaming.landing_stream import land_stream

_PAYLOAD = ", ".join(RAW_COLUMNS)

# Rows loaded before this moment play the stored layer, the others the batch.
CUTOFF = "1998-07-01 00:00:00"
LOAD_TS = "2024-01-31 06:00:00"


def _warehouse(spark: SparkSession, label: str) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, label))


# --- scans and sinks ----------------------------------------------------------


@query("csv_scan", f"SELECT {_PAYLOAD} FROM {{raw}}")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_transactions(raw(spark, sf_dir), path)
    return read_transactions(spark, path)


@query(
    "csv_reject_malformed",
    """SELECT count(*) FILTER (k % 97 <> 0 AND k % 89 <> 0 AND k % 83 <> 0) AS rows_read,
       count(transaction_id) FILTER (k % 97 <> 0 AND k % 89 <> 0 AND k % 83 <> 0) AS ids_read,
       count(*) FILTER (k % 97 = 0 OR k % 89 = 0 OR k % 83 = 0) AS rows_rejected
       FROM (SELECT transaction_id, l_orderkey * 10 + l_linenumber AS k FROM {raw})""",
)
def csv_reject_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a field too few or too many and blank lines are told apart from whole ones."""
    k = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    whole = [F.col(c) for c in RAW_COLUMNS]
    line = (
        F.when(k % 97 == 0, F.to_csv(F.struct(*whole[:6]), CSV_WRITE_OPTIONS))
        .when(
            k % 89 == 0, F.to_csv(F.struct(*whole, F.lit("x").alias("extra")), CSV_WRITE_OPTIONS)
        )
        .when(k % 83 == 0, F.lit(""))
        .otherwise(F.to_csv(F.struct(*whole), CSV_WRITE_OPTIONS))
    )
    path = scratch_path(spark, "malformed")
    raw(spark, sf_dir).select(line.alias("line")).write.text(path)
    rejected = F.col(CORRUPT).isNotNull()
    return read_with_rejects(spark, path, header=False).agg(
        F.count_if(~rejected).alias("rows_read"),
        F.count(F.when(~rejected, F.col("transaction_id"))).alias("ids_read"),
        F.count_if(rejected).alias("rows_rejected"),
    )


@query(
    "varchar_len_check",
    "\nUNION ALL ".join(
        f"""SELECT '{name}' AS column_name, {limit} AS max_allowed,
        CAST(coalesce(max(length({name})), 0) AS INTEGER) AS longest,
        count(*) FILTER (length(rtrim({name}, ' ')) > {limit}) AS too_long FROM {{raw}}"""
        for name, limit in RAW_LIMITS.items()
    ),
)
def varchar_len_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.length_report(raw(spark, sf_dir))


@query("table_scan", "SELECT * FROM {landed}")
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(landed(spark, sf_dir), "landed")


@query("table_overwrite_sink", "SELECT * FROM {fact}")
def table_overwrite_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built twice, whole each time: the second run replaces the first. Both write the same fact, computed once."""
    warehouse = _warehouse(spark, "overwrite")
    with Scratch(spark) as scratch:
        rows = scratch.materialize(fact(spark, sf_dir, scratch.materialize), "fact")
        warehouse.overwrite("fact_transactions", rows)
        return warehouse.overwrite("fact_transactions", rows)


@query(
    "view_sink",
    "SELECT is_valid, count(*) AS row_count FROM {staged} GROUP BY is_valid",
)
def view_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged(spark, sf_dir).createOrReplaceTempView("stg_customer_transactions")
    return spark.sql(
        "SELECT is_valid, count(*) AS row_count FROM stg_customer_transactions GROUP BY is_valid"
    )


@query("raw_append_sink", "SELECT * FROM {landed}")
def raw_append_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, the second one repeated: its partition is replaced, not doubled.

    A third one is repeated without rows: it is gone.
    """
    warehouse = _warehouse(spark, "append")
    rows = materialize(landed(spark, sf_dir), "landed")
    is_new = F.col("loaded_at") >= F.lit(CUTOFF).cast("timestamp_ntz")
    warehouse.append_raw(rows.where(~is_new), "load-1")
    warehouse.append_raw(rows.where(is_new), "load-2")
    warehouse.append_raw(rows.where(is_new), "load-2")
    warehouse.append_raw(rows.where("transaction_id IS NULL"), "load-3")
    warehouse.append_raw(rows.where("false"), "load-3")
    return warehouse.raw()


# --- landing ------------------------------------------------------------------


def _old_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    stored, lines = _stored_and_lines(spark, sf_dir)
    return stored, raw_texts(lines)


def _stored_and_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The stored rows, which win as numbers with their id and become text then, and the batch's lines."""
    lines = order_lines(spark, sf_dir)
    is_new = load_month() >= F.lit(CUTOFF).cast("timestamp_ntz")
    old = lines.where(~is_new).withColumn(landing.ID, transaction_id())
    stored = raw_texts(landing.first_wins(old, DERIVED_POSITION))
    return stored.select(*RAW_COLUMNS, "loaded_at"), lines.where(is_new)


_FIRST = f"row_number() OVER (PARTITION BY transaction_id ORDER BY {_POSITION}) = 1"
_NEW_ROWS = f"""SELECT {_PAYLOAD}, loaded_at FROM {{raw}}
    WHERE loaded_at >= TIMESTAMP '{CUTOFF}'
      AND (transaction_id IS NULL OR transaction_id NOT IN (
           SELECT transaction_id FROM {{raw}}
           WHERE loaded_at < TIMESTAMP '{CUTOFF}' AND transaction_id IS NOT NULL))
    QUALIFY transaction_id IS NULL OR {_FIRST}"""


@query("load_batch_count", "SELECT count(*) AS rows_read FROM {raw}")
def load_batch_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows_read"))


@query("landing_dedup_first_wins", "SELECT * FROM {landed}")
def dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir)


@query("landing_skip_existing", _NEW_ROWS)
def landing_skip_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = _old_and_new(spark, sf_dir)
    return landing.land_batch(batch, stored, DERIVED_POSITION).select(*RAW_COLUMNS, "loaded_at")


@query("landing_indexed", _NEW_ROWS.replace("loaded_at FROM", f"TIMESTAMP '{LOAD_TS}' AS loaded_at FROM"))
def landing_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of every year, then the batch over the index of their ids, repeated after an empty attempt.

    The batch lies in the order of its position, so that one number tells a row's place. Rows of
    one line, of orders or parts that come twice, have one place: they win together.
    """
    warehouse = _warehouse(spark, "indexed")
    stored, lines = _stored_and_lines(spark, sf_dir)
    # Columns before the amounts: the range partitions serve the window too.
    first = DERIVED_POSITION[:5]
    in_order = lines.repartitionByRange(*first).sortWithinPartitions(*DERIVED_POSITION)
    place = F.min("number").over(Window.partitionBy(*first, "row_seq"))
    placed = in_order.withColumn("number", F.monotonically_increasing_id()).withColumn("place", place)
    batch = raw_texts(placed, "place").select(*RAW_COLUMNS, "loaded_at", "place")
    with Scratch(spark) as scratch:
        stored, batch = scratch.materialize(stored, "stored"), scratch.materialize(batch, "batch")
        for year in range(1992, 1999):
            rows = stored.where(F.year("loaded_at") == year)
            warehouse.append_raw(rows, f"year {year}", rows.count(), dealt=True)
        for rows in (batch, batch.where("false"), batch):
            land(warehouse, rows, "batch", LOAD_TS, ["place"])
    return warehouse.raw_load("batch")


@query(
    "load_metrics",
    f"""SELECT r AS rows_read, i AS rows_inserted, r - i AS rows_skipped FROM (
        SELECT (SELECT count(*) FROM {{raw}} WHERE loaded_at >= TIMESTAMP '{CUTOFF}') AS r,
               (SELECT count(*) FROM ({_NEW_ROWS})) AS i)""",
)
def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = _old_and_new(spark, sf_dir)
    return landing.load_metrics(batch, landing.land_batch(batch, stored, DERIVED_POSITION))


@query(
    "load_timestamp",
    f"""SELECT TIMESTAMP '{LOAD_TS}' AS loaded_at, count(*) AS row_count,
        count(DISTINCT transaction_id) AS ids FROM {{landed}}""",
)
def load_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        landing.stamp_load(landed(spark, sf_dir), LOAD_TS)
        .groupBy("loaded_at")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("transaction_id").alias("ids"),
        )
    )


@query(
    "raw_rerun_semantics",
    """SELECT transaction_id IS NOT NULL AS has_id, count(*) AS after_first_load,
       CASE WHEN transaction_id IS NOT NULL THEN count(*) ELSE 2 * count(*) END
           AS after_second_load
       FROM {landed} GROUP BY transaction_id IS NOT NULL""",
)
def raw_rerun_semantics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading the same batch twice adds only the rows without id again."""
    batch = materialize(raw(spark, sf_dir), "batch")
    first = landing.land_batch(batch, None, DERIVED_POSITION)
    second = landing.land_batch(batch, first, DERIVED_POSITION)
    both = first.withColumn("load", F.lit(1)).unionByName(second.withColumn("load", F.lit(2)))
    return both.groupBy(F.col("transaction_id").isNotNull().alias("has_id")).agg(
        F.count_if(F.col("load") == 1).alias("after_first_load"),
        F.count(F.lit(1)).alias("after_second_load"),
    )


@query(
    "landing_stream",
    f"""SELECT {_PAYLOAD}, TIMESTAMP '{LOAD_TS}' AS loaded_at FROM {{raw}}
        QUALIFY transaction_id IS NULL OR row_number() OVER (
            PARTITION BY transaction_id ORDER BY loaded_at, {_POSITION}) = 1""",
)
def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files in load-month order, landed as a stream, then the raw layer.

    Range partitions follow the order, and so do the names of the files. The lines are put in
    order as numbers and become text in their partition; a file holds one partition, packed.
    """
    source = scratch_path(spark, "stream-source")
    order = [load_month(), *DERIVED_POSITION]
    in_order = order_lines(spark, sf_dir).repartitionByRange(*order).sortWithinPartitions(*order)
    with shuffles_deleted(spark):
        write_transactions(raw_texts(in_order), source, compression="gzip")
    warehouse = _warehouse(spark, "stream")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    land_stream(warehouse, source, checkpoint, batch_ts=LOAD_TS).awaitTermination()
    return warehouse.raw()
