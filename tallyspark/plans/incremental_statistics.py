"""Exact quartiles and box plots of a growing table, kept load by load.

A load stores how often each value occurs, in one folder per factor of e, and the totals of
its buckets of 0.1 % width. Totals of all loads add up and locate the buckets in which ranks
and whiskers lie; of the stored values only the folders with such buckets are read. A repeated
load replaces its state. Results equal those over the whole fact; means and deviations agree
up to the rounding of floating-point sums. Values that are NULL or have no group count nowhere.

The manifest that names the state of each load is written aside and renamed; readers of the
one before keep their files, older ones are removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.cleaners import LENIENT
from tallyspark.operators import marts, statistics
from tallyspark.operators.quantiles import bucket_sums, merged_sums, range_of, value_counts
from tallyspark.operators.staging import stage_transactions
from tallyspark.session import Scratch, delete, read_text, replace_text, side_by_side
from tallyspark.sources.tables import Warehouse


@dataclass(frozen=True)
class Sample:
    """Values by group: ``rows`` gives (group, value) of a fact."""

    group: str
    rows: Callable[[DataFrame], DataFrame]

    @property
    def counts_schema(self) -> str:
        return f"{self.group} string, value double, n bigint, bucket bigint, range int"

    @property
    def totals_schema(self) -> str:
        sums = "in_bucket bigint, off double, off_squares double, bucket_min double, bucket_max double"
        return f"{self.group} string, bucket bigint, {sums}"


_PARTS = ("totals", "values")

SAMPLES: Mapping[str, Sample] = {
    "measures": Sample("column_name", statistics.measure_values),
    "prices": Sample("product_name", lambda fact: fact.select("product_name", F.col("unit_price").alias("value"))),
}


@dataclass(frozen=True)
class IncrementalStatistics:
    """Statistics of the fact of a warehouse, from the stored states of its loads."""

    warehouse: Warehouse
    mode: str = LENIENT

    @property
    def base(self) -> str:
        return f"{self.warehouse.base}/incremental_statistics"

    @property
    def _manifest_path(self) -> str:
        return f"{self.base}/_manifest"

    def manifest(self) -> dict:
        """``loads``: the version of the state of each load; ``former``: those before."""
        text = read_text(self.warehouse.spark, self._manifest_path)
        return json.loads(text) if text else {"loads": {}, "former": []}

    def _path(self, name: str, part: str, version: str) -> str:
        return f"{self.base}/{name}/{part}/version={version}"

    def update(self, *load_ids: str) -> None:
        """Store these loads, new, repeated or emptied, and any that is missing, then publish all at once."""
        before = self.manifest()["loads"]
        stored = set(self.warehouse.load_ids())
        changed = sorted({*load_ids, *(stored ^ set(before))})
        if not changed:
            return
        loads = {load: version for load, version in before.items() if load not in changed}
        fresh = [load for load in changed if load in stored]
        loads |= zip(fresh, side_by_side(partial(self._write, load) for load in fresh), strict=True)
        self._publish(before, loads)

    def _write(self, load_id: str) -> str:
        version, spark = f"v{uuid.uuid4().hex}", self.warehouse.spark
        with Scratch(spark) as scratch:
            fact = marts.fact_transactions(stage_transactions(self.warehouse.raw_load(load_id), self.mode))
            fact = scratch.materialize(fact.select("product_name", *statistics.FACT_MEASURES), "fact")
            side_by_side(
                partial(self._write_sample, scratch, fact, name, sample, version) for name, sample in SAMPLES.items()
            )
        return version

    def _write_sample(self, scratch: Scratch, fact: DataFrame, name: str, sample: Sample, version: str) -> None:
        counts = value_counts(sample.rows(fact), sample.group, "value")
        counts = scratch.materialize(counts.withColumn("range", range_of(F.col("bucket"))), name)
        bucket_sums(counts, sample.group).write.parquet(self._path(name, "totals", version))
        # Cut by size, so that a folder with many values is written by many tasks.
        place = ["range", "bucket", "value"]
        ordered = counts.repartitionByRange(*place).sortWithinPartitions(*place)
        ordered.write.partitionBy("range").parquet(self._path(name, "values", version))

    def _publish(self, before: Mapping[str, str], loads: Mapping[str, str]) -> None:
        former = self.manifest()["former"]
        content = {"loads": loads, "former": sorted(before.values())}
        replace_text(self.warehouse.spark, self._manifest_path, json.dumps(content))
        for version in set(former) - set(before.values()) - set(loads.values()):
            for name in SAMPLES:
                for part in _PARTS:
                    delete(self.warehouse.spark, self._path(name, part, version))

    def _stored(self, name: str, part: str, schema: str) -> DataFrame:
        spark = self.warehouse.spark
        paths = [self._path(name, part, version) for version in self.manifest()["loads"].values()]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.option("basePath", f"{self.base}/{name}/{part}").schema(schema).parquet(*paths)

    def _totals(self, name: str) -> DataFrame:
        sample = SAMPLES[name]
        return merged_sums(self._stored(name, "totals", sample.totals_schema), sample.group)

    def _read(self, name: str, wanted: DataFrame) -> DataFrame:
        """Value counts of all loads in the wanted buckets.

        The driver sees the numbers of the folders, fewer than 3,000 for all doubles there are.
        """
        sample = SAMPLES[name]
        folders = [row[0] for row in wanted.select(range_of(F.col("bucket"))).distinct().collect()]
        values = self._stored(name, "values", sample.counts_schema).where(F.col("range").isin(folders))
        hits = values.join(wanted, [sample.group, "bucket"])
        return hits.groupBy(*wanted.columns, "value").agg(F.sum("n").alias("n"))

    def describe_numeric(self) -> DataFrame:
        """As ``statistics.describe_numeric`` over the fact of all loads."""
        return statistics.described(self._totals("measures"), lambda wanted: self._read("measures", wanted))

    def boxplot_stats(self) -> DataFrame:
        """As ``statistics.boxplot_stats`` over the fact of all loads."""
        return statistics.boxplots(self._totals("prices"), lambda wanted: self._read("prices", wanted), "product_name")
