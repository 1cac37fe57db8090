"""Incremental landing of newly arriving CSV files."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallyspark.plans.daily_run import land
from tallyspark.sources import csv_lines
from tallyspark.sources.csv_source import parsed
from tallyspark.sources.tables import Warehouse


def land_stream(
    warehouse: Warehouse,
    source: str,
    checkpoint: str,
    name: str = "stream",
    batch_ts: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Land all files not seen yet, then stop.

    No streaming state is kept: the raw layer itself tells which ids exist. A
    replayed micro-batch replaces its own partition, so rows without id do not
    double. A file that is rewritten under the same path is not read again;
    reload such files with the batch job. Malformed rows and blank lines stop the stream.
    """
    reader = warehouse.spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def land_files(batch: DataFrame, batch_id: int) -> None:
        here = Warehouse(batch.sparkSession, warehouse.base)
        moment = batch_ts or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        land(here, parsed(csv_lines.single_lines(batch)), f"{name}-{batch_id:09d}", moment)

    return (
        csv_lines.with_place(reader.text(source))
        .writeStream.foreachBatch(land_files)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
