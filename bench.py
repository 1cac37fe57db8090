"""Benchmark: prints one JSON line with seconds per query.

The raw rows are derived once from the tables in $BENCH_SF_DIR and written as
CSV files; that is preparation and not timed. Timed are the load of those files
and every query over stored tables, as a daily run executes them, and a few
registered queries end to end, from the original tables to the result. One
warm-up, then the median of $BENCH_RUNS runs.
"""

from __future__ import annotations

import json
import os
import statistics as stats
import sys
import tempfile
import time

os.environ.setdefault("TALLYSPARK_DRIVER_MEMORY", "12g")

from tallyspark.operators import audit, marts, quality, ranking, star
from tallyspark.operators import statistics as explore
from tallyspark.operators.landing import first_wins
from tallyspark.operators.staging import stage_transactions
from tallyspark.plans import queries as catalog
from tallyspark.plans.daily_run import build_tables, land
from tallyspark.session import local_session
from tallyspark.sources.csv_source import FILE_POSITION, read_batch, write_transactions
from tallyspark.plans.queries.derived import raw_transactions
from tallyspark.sources.tables import Warehouse

END_TO_END = (
    "agg_by_customer",
    "dim_customers",
    "audit_errors_by_load_date",
    "landing_skip_existing",
    "describe_numeric",
)


def drain(df) -> None:
    """Compute every row and column without storing them."""
    df.write.format("noop").mode("overwrite").save()


def prepare(spark, sf_dir: str, cpus: int, folder: str) -> tuple[Warehouse, str]:
    files = f"{folder}/csv"
    write_transactions(raw_transactions(spark, sf_dir).repartition(2 * cpus, "l_orderkey"), files)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    land(warehouse, read_batch(spark, files), "prepared", "2024-01-31 06:00:00")
    build_tables(warehouse)
    return warehouse, files


def timed_steps(spark, warehouse: Warehouse, files: str, sf_dir: str, folder: str):
    raw = warehouse.raw()
    staged = stage_transactions(raw)
    fact = warehouse.table("fact_transactions")
    pairs = warehouse.table("agg_by_customer_product")
    customers = warehouse.table("agg_by_customer")
    tables = {
        name: staged if name.startswith("stg_") else warehouse.table(name) for name in quality.SUITE
    }
    loads = iter(range(1_000_000))

    def load_again():
        """A new warehouse each time, so that every run inserts the same rows."""
        fresh = Warehouse(spark, f"{folder}/load-{next(loads)}")
        land(fresh, read_batch(spark, files), "day", "2024-01-31 06:00:00").collect()

    def reload_all():
        """The same files once more into a full raw layer: only rows without id are new."""
        land(warehouse, read_batch(spark, files), "again", "2024-02-01 06:00:00").collect()

    steps = {
        "land_csv": load_again,
        "land_csv_existing": reload_all,
        "first_wins": lambda: drain(first_wins(read_batch(spark, files), FILE_POSITION)),
        "stage": lambda: drain(staged),
        "fact_transactions": lambda: drain(marts.fact_transactions(staged)),
        "dim_customers": lambda: drain(marts.dim_customers(staged)),
        "agg_by_customer": lambda: drain(marts.agg_by_customer(fact)),
        "agg_by_product": lambda: drain(marts.agg_by_product(fact)),
        "agg_by_customer_product": lambda: drain(marts.agg_by_customer_product(fact)),
        "audit_errors_by_customer": lambda: drain(audit.errors_by_customer(staged)),
        "audit_errors_by_load_date": lambda: drain(audit.errors_by_load_date(staged)),
        "dq_suite": lambda: quality.run_suite(tables).collect(),
        "star_slice": lambda: drain(
            star.star_slice(
                star.fact_star(fact),
                warehouse.table("dim_customers"),
                star.dim_products(fact),
                star.dim_date(fact),
                7,
            )
        ),
        "kpi_summary": lambda: drain(explore.kpi_summary(fact)),
        "describe_numeric": lambda: drain(explore.describe_numeric(fact)),
        "correlation_matrix": lambda: drain(explore.correlation_matrix(fact)),
        "boxplot_stats": lambda: drain(explore.boxplot_stats(fact)),
        "linreg": lambda: drain(explore.linear_fit(fact, "quantity", "gross_amount")),
        "pivot": lambda: drain(explore.customer_product_pivot(pairs)),
        "daily_activity": lambda: drain(explore.daily_activity(fact)),
        "rank_customers": lambda: drain(ranking.ranked(customers, "total_paid", ["customer_id"])),
    }
    for name in END_TO_END:
        steps[f"e2e_{name}"] = lambda q=catalog.queries()[name]: drain(q(spark, sf_dir))
    return steps


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    folder = tempfile.mkdtemp(prefix="bench-")
    spark = local_session("bench", cpus, **{"spark.checkpoint.dir": f"{folder}/shared"})
    warehouse, files = prepare(spark, sf_dir, cpus, folder)
    raw_rows = raw_transactions(spark, sf_dir).count()

    # Steps are bound to the tables as prepared; a later load does not change them.
    seconds = {}
    for name, step in timed_steps(spark, warehouse, files, sf_dir, folder).items():
        step()
        samples = []
        for _ in range(runs):
            started = time.perf_counter()
            step()
            samples.append(time.perf_counter() - started)
        seconds[name] = round(stats.median(samples), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "raw_rows": raw_rows,
                "raw_rows_per_sec": {
                    name: round(raw_rows / s)
                    for name, s in seconds.items()
                    if name in ("land_csv", "stage", "fact_transactions", "dim_customers")
                },
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
