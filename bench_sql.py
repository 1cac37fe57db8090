"""Seconds of the benchmark's table queries in DuckDB, as a single-node yardstick.

There are no published numbers to match. This runs the SQL that checks the
Spark queries over the same raw rows, stored as Parquet, with as many threads
as the benchmark has cores, and prints one JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import statistics as stats
import tempfile
import time

import duckdb

from tallyspark.plans.queries import base, oracle_sql

# Benchmark step -> layer or registered query.
STEPS = {
    "stage": "stage_transactions",
    "fact_transactions": "fact",
    "dim_customers": "dim_customers",
    "agg_by_customer": "agg_by_customer",
    "agg_by_product": "agg_by_product",
    "agg_by_customer_product": "agg_by_customer_product",
    "audit_errors_by_customer": "errors_by_customer",
    "audit_errors_by_load_date": "errors_by_load_date",
    "kpi_summary": "kpi_summary",
    "describe_numeric": "describe_numeric",
    "correlation_matrix": "correlation_matrix",
    "boxplot_stats": "boxplot_stats",
    "linreg": "linreg_quantity_gross",
    "daily_activity": "daily_activity",
}
END_TO_END = (
    "agg_by_customer",
    "dim_customers",
    "audit_errors_by_load_date",
    "landing_skip_existing",
    "describe_numeric",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    folder = tempfile.mkdtemp(prefix="bench-sql-")
    con = duckdb.connect()
    con.execute(f"SET threads = {int(os.environ.get('BENCH_CPUS', os.cpu_count() or 8))}")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")

    seconds = {}

    def clock(step: str, sql: str) -> None:
        samples = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            con.execute(f"CREATE OR REPLACE TEMP TABLE drained AS {sql}")
            samples.append(time.perf_counter() - started)
        seconds[step] = round(stats.median(samples[1:]), 3)

    for name in END_TO_END:
        clock(f"e2e_{name}", oracle_sql()[name])
    for layer, file in (("landed", "landed"), ("fact", "fact")):
        target = f"{folder}/{file}.parquet"
        con.execute(f"COPY ({base.with_layers(f'SELECT * FROM {{{layer}}}')}) TO '{target}'")
        con.execute(f"CREATE VIEW {layer} AS SELECT * FROM read_parquet('{target}')")
        if layer == "landed":
            con.execute(f"CREATE VIEW staged AS {base.sql_over_views('staged')}")
    for step, name in STEPS.items():
        clock(step, base.sql_over_views(name))
    print(json.dumps({"queries": seconds}))


if __name__ == "__main__":
    main()
