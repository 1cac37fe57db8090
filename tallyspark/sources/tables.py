"""Named tables of the layers below one folder."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.schemas import RAW_COLUMNS, RAW_SCHEMA
from tallyspark.session import CODEC, delete, file_system, read_text, replace_text
from tallyspark.sources import id_index

# The schema each table belongs to.
LAYER = {
    "dim_customers": "analytics",
    "dim_products": "analytics",
    "dim_date": "analytics",
    "fact_transactions": "analytics",
    "fact_star": "analytics",
    "agg_by_customer": "analytics",
    "agg_by_product": "analytics",
    "agg_by_customer_product": "analytics",
    "audit_errors_by_customer": "auditing",
    "audit_errors_by_load_date": "auditing",
}

# Names the version of every table that readers see.
_MANIFEST = "_tables"

_STORED_RAW = T.StructType(
    [*RAW_SCHEMA.fields, T.StructField("load_id", T.StringType()), T.StructField("id_bucket", T.LongType())]
)
_STORED_INDEX = T.StructType([*id_index.SCHEMA.fields, T.StructField("load_id", T.StringType())])


@dataclass(frozen=True)
class Warehouse:
    """Paths and readers. ``base`` must be reachable from every executor."""

    spark: SparkSession
    base: str

    @property
    def raw_path(self) -> str:
        return f"{self.base}/raw/customer_transactions"

    def path(self, table: str) -> str:
        return f"{self.base}/{LAYER[table]}/{table}"

    def _manifest(self) -> dict[str, str]:
        text = read_text(self.spark, f"{self.base}/{_MANIFEST}")
        return json.loads(text) if text else {}

    def table(self, name: str) -> DataFrame:
        """The published version of a table."""
        return self.version(name, self._manifest().get(name, ""))

    def snapshot(self) -> dict[str, DataFrame]:
        """All published tables, all of the same moment, whatever is published later."""
        return {name: self.version(name, version) for name, version in self._manifest().items()}

    def write_version(self, name: str, df: DataFrame) -> str:
        """Store a table beside the published version, unseen by readers."""
        version = f"version-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path(name)}/{version}")
        return version

    def version(self, name: str, version: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path(name)}/{version}")

    def publish(self, versions: Mapping[str, str]) -> None:
        """Switch readers to the given versions, all at once.

        One manifest names the versions of all tables; it is written aside and renamed over
        the old one, so a reader sees the tables of one run or of the other, and a run that
        breaks off leaves the former ones. Readers that began before keep the files of the
        former versions; what is older than that is removed.
        """
        former = self._manifest()
        replace_text(self.spark, f"{self.base}/{_MANIFEST}", json.dumps(former | dict(versions)))
        for name, version in versions.items():
            self._keep_only(name, (version, former.get(name)))

    def discard(self, versions: Mapping[str, str]) -> None:
        for name, version in versions.items():
            delete(self.spark, f"{self.path(name)}/{version}")

    def overwrite(self, name: str, df: DataFrame) -> DataFrame:
        """Rebuild a table from a query and read it back; it is never missing meanwhile."""
        version = self.write_version(name, df)
        self.publish({name: version})
        return self.version(name, version)

    def _keep_only(self, name: str, kept: tuple[str | None, ...]) -> None:
        fs, folder = file_system(self.spark, self.path(name))
        for status in fs.listStatus(folder):
            found = status.getPath().getName()
            if found.startswith("version-") and found not in kept:
                fs.delete(status.getPath(), True)

    @property
    def index_path(self) -> str:
        return f"{self.base}/raw/transaction_id_index"

    def _stored(self, path: str, schema: T.StructType) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _raw_or_none(self) -> DataFrame | None:
        return self._stored(self.raw_path, _STORED_RAW)

    def raw(self) -> DataFrame:
        """The raw layer; empty before the first load."""
        rows = self._raw_or_none()
        if rows is None:
            return self.spark.createDataFrame([], RAW_SCHEMA)
        return rows.select(*RAW_COLUMNS, "loaded_at")

    def raw_except(self, load_id: str) -> DataFrame | None:
        """The raw layer without one load, which a retry is about to replace."""
        rows = self._raw_or_none()
        return None if rows is None else rows.where(F.col("load_id") != load_id)

    def raw_candidates(self, batch: DataFrame, load_id: str) -> DataFrame | None:
        """The buckets of other loads that may hold an id of the batch; only they are read.

        The id index of the stored loads tells them. A load whose index is missing, because
        it was written without one or its load broke off, is read whole. The driver sees
        names of partitions, as it does whenever it lists a table.
        """
        others = self.raw_except(load_id)
        if others is None:
            return None
        index = self._stored(self.index_path, _STORED_INDEX)
        folders = self.load_ids()
        indexed = set() if index is None else self._names_below(self.index_path)
        wanted = F.col("load_id").isin(sorted(folders - indexed))
        if index is not None:
            for load, buckets in id_index.candidates(index.where(F.col("load_id") != load_id), batch).items():
                wanted = wanted | ((F.col("load_id") == load) & F.col("id_bucket").isin(buckets))
        return others.where(wanted)

    def _names_below(self, path: str) -> set[str]:
        """The load ids that a partitioned folder holds."""
        fs, folder = file_system(self.spark, path)
        if not fs.exists(folder):
            return set()
        found = [status.getPath().getName() for status in fs.listStatus(folder) if status.isDirectory()]
        return {unquote(name.removeprefix("load_id=")) for name in found if name.startswith("load_id=")}

    def load_ids(self) -> set[str]:
        return self._names_below(self.raw_path)

    def raw_load(self, load_id: str) -> DataFrame:
        rows = self._raw_or_none()
        if rows is None:
            return self.spark.createDataFrame([], RAW_SCHEMA)
        return rows.where(F.col("load_id") == load_id).select(*RAW_COLUMNS, "loaded_at")

    def append_raw(
        self,
        rows: DataFrame,
        load_id: str,
        most_rows: int = 0,
        position: Sequence[str] = RAW_COLUMNS,
        dealt: bool = False,
    ) -> None:
        """Write one load as its own partition, in buckets of its ids, and then its id index.

        ``most_rows`` bounds the rows from above and sets the number of buckets; ``position``
        names columns that spread the rows without id. ``dealt`` tells that the rows lie by slot
        and id, as the landing leaves them: each task then writes its own buckets and the rows
        are not shuffled again. A column ``__slot`` takes the place of ``position``. A retry replaces its load only: the
        index is removed first, so that a load that breaks off is never looked up in an old
        one, and buckets that the retry no longer has are removed after it.
        """
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions")) if dealt else 1
        buckets, blocks = id_index.geometry(most_rows, tasks)
        self._drop_index(load_id)
        former = self._bucket_folders(load_id)
        slot = F.col(id_index.SLOT) if id_index.SLOT in rows.columns else None
        bucket = id_index.bucket_of(buckets, position, slot).alias("id_bucket")
        stored = rows.select(*RAW_COLUMNS, "loaded_at", bucket, F.lit(load_id).alias("load_id"))
        if buckets > 1 and not dealt:
            stored = stored.repartition("id_bucket")
        written = Observation()
        (
            stored.observe(written, F.collect_set("id_bucket").alias("buckets"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("load_id", "id_bucket")
            .parquet(self.raw_path, compression=CODEC)
        )
        # A repeated task may report a bucket twice, but none reports one without rows.
        kept = set(written.get["buckets"] or [])
        for number, folder in former.items():
            if number not in kept:
                delete(self.spark, folder)
        if kept:
            self._write_index(load_id, buckets, blocks)

    def _write_index(self, load_id: str, buckets: int, blocks: int) -> None:
        stored = self._raw_or_none().where(F.col("load_id") == load_id)
        built = id_index.build(stored, buckets, blocks).withColumn("load_id", F.lit(load_id))
        (
            built.coalesce(max(buckets * blocks // id_index.BUCKET_BLOCKS, 1))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("load_id")
            .parquet(self.index_path, compression=CODEC)
        )

    def _drop_index(self, load_id: str) -> None:
        fs, folder = file_system(self.spark, self.index_path)
        if not fs.exists(folder):
            return
        for status in fs.listStatus(folder):
            if unquote(status.getPath().getName()) == f"load_id={load_id}":
                fs.delete(status.getPath(), True)

    def _bucket_folders(self, load_id: str) -> dict[int, str]:
        """The folders that hold the rows of a load, by bucket."""
        rows = self._raw_or_none()
        if rows is None or load_id not in self.load_ids():
            return {}
        files = rows.where(F.col("load_id") == load_id).select("id_bucket", F.col("_metadata.file_path").alias("f"))
        # The metadata column gives addresses, which escape what a path holds as it is.
        return {row.id_bucket: unquote(row.f).rsplit("/", 1)[0] for row in files.distinct().collect()}
