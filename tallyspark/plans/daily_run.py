"""The daily run: land a batch, rebuild the tables, check them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.cleaners import LENIENT
from tallyspark.operators import audit, landing, marts, quality, star
from tallyspark.operators.staging import stage_transactions
from tallyspark.session import Scratch
from tallyspark.sources.csv_source import FILE_POSITION, read_batch
from tallyspark.sources.tables import Warehouse

# Fixed value: how many tables are rebuilt at a time.
PARALLEL_TABLES = 4

_FILE = "__file"

FROM_STAGING: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "fact_transactions": marts.fact_transactions,
    "dim_customers": marts.dim_customers,
    "audit_errors_by_customer": audit.errors_by_customer,
    "audit_errors_by_load_date": audit.errors_by_load_date,
}
FROM_FACT: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "agg_by_customer": marts.agg_by_customer,
    "agg_by_product": marts.agg_by_product,
    "agg_by_customer_product": marts.agg_by_customer_product,
}
STAR_EXTENSION: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "dim_products": star.dim_products,
    "dim_date": star.dim_date,
    "fact_star": star.fact_star,
}


@dataclass(frozen=True)
class RunResult:
    metrics: DataFrame
    checks: DataFrame


def land(
    warehouse: Warehouse,
    batch: DataFrame,
    load_id: str,
    batch_ts: str,
    position: Sequence[str] = FILE_POSITION,
) -> DataFrame:
    """Append the new rows of a batch to the raw layer and return the load metrics.

    The batch is written to the shared folder first, so that its CSV is parsed once.
    Malformed or overlong rows stop the load there, before the raw layer is touched; the
    counts come from files, not from accumulators that a lost executor would count twice.
    Of the stored loads only the buckets are read that may hold an id of the batch.
    Repeating a load with the same ``load_id`` replaces it, also by nothing.
    """
    with Scratch(warehouse.spark) as scratch:
        staged = scratch.materialize(landing.enforce_lengths(batch), "batch")
        target = warehouse.raw_candidates(staged, load_id)
        if tuple(position) == FILE_POSITION:
            rows = landing.land_slotted(_files_numbered(staged), target, (_FILE, *FILE_POSITION[1:]))
        else:
            rows = landing.land_slotted(staged, target, position)
        warehouse.append_raw(landing.stamp_load(rows, batch_ts), load_id, staged.count(), position, dealt=True)
        return _local(landing.load_metrics(staged, warehouse.raw_load(load_id)))


def _files_numbered(staged: DataFrame) -> DataFrame:
    """The file's number in the order of the names for its path: rows are sorted and moved without a long text.

    The driver sees the names of the files, as it does when it lists them.
    """
    name = FILE_POSITION[0]
    names = sorted((row[0] for row in staged.select(name).distinct().collect() if row[0] is not None), key=str.encode)
    numbers = staged.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], f"{name} string, {_FILE} int")
    return staged.join(F.broadcast(numbers), name, "left").drop(name)


def _local(report: DataFrame) -> DataFrame:
    """A report of a few rows, kept without the tables it was made from."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def _rebuild(
    warehouse: Warehouse,
    queries: Mapping[str, Callable[[DataFrame], DataFrame]],
    source: DataFrame,
) -> dict[str, str]:
    """Write tables side by side, so that one job's tail does not idle the cluster."""
    with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
        jobs = {
            name: pool.submit(warehouse.write_version, name, query(source))
            for name, query in queries.items()
        }
        return {name: job.result() for name, job in jobs.items()}


def write_tables(
    warehouse: Warehouse, staged: DataFrame, with_star: bool = False
) -> dict[str, str]:
    """Write a new version of every table from written staging; readers do not see them yet."""
    versions = _rebuild(warehouse, FROM_STAGING, staged)
    # The aggregates read the written fact, not the staging behind it.
    fact = warehouse.version("fact_transactions", versions["fact_transactions"])
    from_fact = {**FROM_FACT, **(STAR_EXTENSION if with_star else {})}
    return versions | _rebuild(warehouse, from_fact, fact)


def build_tables(
    warehouse: Warehouse, mode: str = LENIENT, with_star: bool = False
) -> dict[str, DataFrame]:
    """Rebuild and publish every table; the raw layer is scanned and cleaned once."""
    with Scratch(warehouse.spark) as scratch:
        versions = write_tables(warehouse, _stage(warehouse, scratch, mode), with_star)
    warehouse.publish(versions)
    return {name: warehouse.version(name, version) for name, version in versions.items()}


def _stage(warehouse: Warehouse, scratch: Scratch, mode: str) -> DataFrame:
    """Clean the raw layer once, into a table of the run; for users staging is a view."""
    staged = stage_transactions(warehouse.raw(), mode)
    staged.createOrReplaceTempView("stg_customer_transactions")
    return scratch.materialize(staged, "staging")


def run(
    warehouse: Warehouse,
    paths: str | Sequence[str],
    load_id: str,
    batch_ts: str,
    mode: str = LENIENT,
    with_star: bool = False,
    check_first: bool = False,
    stop_on_failure: bool = True,
    multi_line: bool = False,
) -> RunResult:
    """Land, build, check.

    By default the tables are published and then checked. With ``check_first`` they are
    checked before readers see them; if a check fails, the former versions stay, and the
    run stops or, without ``stop_on_failure``, returns the failed checks.
    """
    spark = warehouse.spark
    metrics = land(warehouse, read_batch(spark, paths, multi_line), load_id, batch_ts)
    with Scratch(spark) as scratch:
        staging = _stage(warehouse, scratch, mode)
        versions = write_tables(warehouse, staging, with_star)
        if not check_first:
            warehouse.publish(versions)
        tables = {name: warehouse.version(name, version) for name, version in versions.items()}
        checks = _local(quality.run_suite(tables | {"stg_customer_transactions": staging}))
    if check_first:
        if checks.where("NOT passed").isEmpty():
            warehouse.publish(versions)
        else:
            warehouse.discard(versions)
    if stop_on_failure:
        quality.gate(checks)
    return RunResult(metrics, checks)
