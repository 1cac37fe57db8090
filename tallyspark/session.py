"""Session helpers: where shared files go, and a session for local runs."""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"

# Intermediate tables, the raw layer and its index: smaller files are worth the packing.
CODEC = "zstd"

# Fixed value: how many independent writes run at a time.
PARALLEL_WRITES = 4

# Under this setting the shuffle files of a query are deleted when it ends, not when the driver's memory is cleared.
_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

T = TypeVar("T")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster."""
    named = spark.conf.get(SHARED_DIR_CONF, None)
    if not named:
        raise ValueError(f"{SHARED_DIR_CONF} must name a folder that all executors reach")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tallyspark/{label}-{uuid.uuid4().hex}"


_cleaning = threading.Lock()
# Session -> how many blocks delete its shuffle files, and the setting before the first of them.
_cleaners: dict[str, tuple[int, str | None]] = {}


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries made and ended in this block leave no shuffle files; the session's setting comes back after it.

    Blocks may nest and run side by side. What a query wrote or returned does not need its
    shuffles any more, and a query that runs again shuffles again.
    """
    session = spark._jsparkSession.sessionUUID()
    with _cleaning:
        blocks, former = _cleaners.get(session) or (0, spark.conf.get(_CLEANUP_CONF, None))
        _cleaners[session] = blocks + 1, former
        spark.conf.set(_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        with _cleaning:
            blocks, former = _cleaners.pop(session)
            if blocks > 1:
                _cleaners[session] = blocks - 1, former
            elif former is None:
                spark.conf.unset(_CLEANUP_CONF)
            else:
                spark.conf.set(_CLEANUP_CONF, former)


def _written(df: DataFrame, path: str) -> DataFrame:
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once and read back: cuts the lineage where several jobs read ``df``.

    A written table survives the loss of an executor and, unlike a cached or
    checkpointed row set, later readers still prune its columns. The shuffles behind it go.
    """
    return _written(df, scratch_path(df.sparkSession, label))


def side_by_side(writes: Iterable[Callable[[], T]]) -> list[T]:
    """Run independent writes a few at a time, so that one job's tail does not idle the cluster."""
    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
        return [job.result() for job in [pool.submit(write) for write in writes]]


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object for a path."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def delete(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None if there is none."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file aside and rename it over the old one: readers see either whole."""
    fs, target = file_system(spark, path)
    _, draft = file_system(spark, f"{path}-{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs.Options, "Rename")
    overwrite = spark.sparkContext._gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext
    context.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, overwrite)


class Scratch:
    """Written intermediate tables of one run, deleted together at its end; its queries leave no shuffle files."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = scratch_path(spark, "run")
        self.count = 0

    def materialize(self, df: DataFrame, label: str) -> DataFrame:
        self.count += 1
        return _written(df, f"{self.base}/{self.count:03d}-{label}")

    def __enter__(self) -> Scratch:
        self.cleaning = shuffles_deleted(self.spark)
        self.cleaning.__enter__()
        return self

    def __exit__(self, *_: object) -> None:
        self.cleaning.__exit__(None, None, None)
        delete(self.spark, self.base)


def local_session(app: str = "tallyspark", cpus: int | str = 8, **conf: str) -> SparkSession:
    """Session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        # Recording the Python call site of every column costs more than small queries.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TALLYSPARK_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
