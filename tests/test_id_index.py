"""The id index: no stored id is missed, few buckets are read, retries and lost indexes."""

import shutil

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import landing
from tallyspark.plans.daily_run import land
from tallyspark.schemas import RAW_COLUMNS
from tallyspark.sources import id_index
from tallyspark.sources.tables import Warehouse


def rows_of(spark, first, last, step=1, prefix="T"):
    ids = spark.range(first, last, step).select(F.concat(F.lit(prefix), "id").alias("transaction_id"), F.col("id").alias("pos"))
    empty = [F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS if c != "transaction_id"]
    return ids.select("transaction_id", *empty, F.lit(None).cast("timestamp_ntz").alias("loaded_at"), "pos")


def files(df):
    """The files that a scan reads: its filter is on partitions, so each of them gives rows."""
    return {row[0] for row in df.select(F.input_file_name()).distinct().collect()}


def test_geometry():
    assert id_index.geometry(0) == id_index.geometry(1) == id_index.geometry(id_index.BLOCK_IDS) == (1, 1)
    assert id_index.geometry(id_index.BLOCK_IDS + 1) == (1, 2)
    buckets, blocks = id_index.geometry(10**9)
    assert blocks == id_index.BUCKET_BLOCKS and buckets * blocks * id_index.BLOCK_IDS >= 10**9


def test_every_stored_id_is_found_and_hardly_any_other(spark):
    buckets, blocks = 4, 2
    stored = rows_of(spark, 0, 30_000).withColumn("id_bucket", id_index.bucket_of(buckets, ["pos"]))
    index = id_index.build(stored, buckets, blocks).withColumn("load_id", F.lit("a")).cache()
    assert index.count() == buckets * blocks + 1
    for number in (1, 17, 29_999):
        one = rows_of(spark, number, number + 1)
        bucket = one.select(id_index.bucket_of(buckets, ["pos"])).first()[0]
        assert id_index.candidates(index, one) == {"a": [bucket]}
    strangers = rows_of(spark, 0, 20_000, prefix="X")
    asked = [id_index.candidates(index, strangers.where(f"pos % 50 = {k}")) for k in range(5)]
    assert sum(len(found.get("a", [])) for found in asked) <= 1
    index.unpersist()


def test_only_buckets_that_may_hold_an_id_are_read(spark, tmp_path, monkeypatch):
    """Eight loads of several buckets; a batch repeats ids of one bucket of one load."""
    monkeypatch.setattr(id_index, "BUCKET_BLOCKS", 1)
    monkeypatch.setattr(id_index, "BLOCK_IDS", 250)
    warehouse = Warehouse(spark, str(tmp_path))
    for day in range(8):
        land(warehouse, rows_of(spark, 1000 * day, 1000 * day + 900), f"day-{day}", "2024-01-01 00:00:00", ["pos"])
    assert len(files(warehouse.raw())) == 32
    again = rows_of(spark, 7003, 7004).unionByName(rows_of(spark, 50_000, 50_040))
    target = warehouse.raw_candidates(again, "next")
    assert 1 <= len(files(target)) <= 2
    assert [r.transaction_id for r in target.where("transaction_id = 'T7003'").collect()] == ["T7003"]
    metrics = land(warehouse, again, "next", "2024-01-02 00:00:00", ["pos"]).first()
    assert tuple(metrics) == (41, 40, 1)
    nothing_new = warehouse.raw_candidates(rows_of(spark, 90_000, 90_010), "later")
    assert len(files(nothing_new)) <= 1
    scan = target._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan


def test_hot_and_missing_ids(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    hot = rows_of(spark, 0, 3000).withColumn("transaction_id", F.when(F.col("pos") % 3 > 0, "T7").when(F.col("pos") % 2 > 0, "T8"))
    first = land(warehouse, hot, "a", "2024-01-01 00:00:00", ["pos"]).first()
    assert tuple(first) == (3000, 502, 2498)
    second = land(warehouse, hot, "b", "2024-01-02 00:00:00", ["pos"]).first()
    assert tuple(second) == (3000, 500, 2500)
    only_missing = warehouse.raw_candidates(hot.where("transaction_id IS NULL"), "c")
    assert files(only_missing) == set()


def test_a_retry_with_fewer_buckets_leaves_no_old_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(id_index, "BUCKET_BLOCKS", 1)
    monkeypatch.setattr(id_index, "BLOCK_IDS", 100)
    warehouse = Warehouse(spark, str(tmp_path))
    land(warehouse, rows_of(spark, 0, 800), "a/b c", "2024-01-01 00:00:00", ["pos"])
    assert len(files(warehouse.raw())) == 8
    land(warehouse, rows_of(spark, 0, 150), "a/b c", "2024-01-01 00:05:00", ["pos"])
    assert warehouse.raw().count() == 150 and len(files(warehouse.raw())) == 2
    # Ids of the first attempt only are free again, the others are not.
    assert tuple(land(warehouse, rows_of(spark, 100, 200), "d", "2024-01-02 00:00:00", ["pos"]).first()) == (100, 50, 50)
    land(warehouse, rows_of(spark, 0, 0), "a/b c", "2024-01-01 00:06:00", ["pos"])
    assert warehouse.raw().count() == 50
    assert tuple(land(warehouse, rows_of(spark, 0, 10), "e", "2024-01-03 00:00:00", ["pos"]).first()) == (10, 10, 0)


def test_a_load_without_index_is_read_whole(spark, tmp_path):
    """As after a load that broke off between its rows and its index."""
    warehouse = Warehouse(spark, str(tmp_path))
    land(warehouse, rows_of(spark, 0, 50), "a", "2024-01-01 00:00:00", ["pos"])
    land(warehouse, rows_of(spark, 50, 60), "b", "2024-01-01 00:00:00", ["pos"])
    shutil.rmtree(f"{warehouse.index_path}/load_id=a")
    assert tuple(land(warehouse, rows_of(spark, 40, 70), "c", "2024-01-02 00:00:00", ["pos"]).first()) == (30, 10, 20)
    shutil.rmtree(warehouse.index_path)
    assert tuple(land(warehouse, rows_of(spark, 40, 70), "d", "2024-01-02 00:00:00", ["pos"]).first()) == (30, 0, 30)


def test_a_load_that_breaks_off_leaves_no_old_index(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    land(warehouse, rows_of(spark, 0, 50), "a", "2024-01-01 00:00:00", ["pos"])

    def breaks(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, "_write_index", breaks)
        with pytest.raises(RuntimeError):
            land(warehouse, rows_of(spark, 100, 150), "a", "2024-01-01 00:01:00", ["pos"])
    assert tuple(land(warehouse, rows_of(spark, 90, 160), "b", "2024-01-02 00:00:00", ["pos"]).first()) == (70, 20, 50)


def test_no_index_no_loads(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert warehouse.raw_candidates(rows_of(spark, 0, 3), "a") is None
    landing.land_batch(rows_of(spark, 0, 3), None, ["pos"]).collect()


def test_cells_follow_the_tasks():
    """No bucket and no block of a large load is spread over tasks; small loads keep few blocks."""
    for rows in (10**6, 36 * 10**6, 216 * 10**6, 10**9):
        buckets, blocks = id_index.geometry(rows, 200)
        assert (buckets * blocks) % 200 == 0 and (200 % buckets == 0 or buckets % 200 == 0)
        assert rows <= buckets * blocks * id_index.BLOCK_IDS < 4 * rows
    assert id_index.geometry(5000, 200) == id_index.geometry(5000)


def test_landed_rows_lie_in_their_buckets(spark, tmp_path, monkeypatch):
    """The shuffle that finds the winners is the only one of the rows."""
    monkeypatch.setattr(id_index, "BUCKET_BLOCKS", 1)
    monkeypatch.setattr(id_index, "BLOCK_IDS", 250)
    rows = rows_of(spark, 0, 900).withColumn("transaction_id", F.when(F.col("pos") % 9 > 0, F.col("transaction_id")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        landed = landing.land_slotted(rows, None, ["pos"])
        bucket = id_index.bucket_of(4, ["pos"], F.col(id_index.SLOT))
        assert landed.select(F.spark_partition_id(), bucket).distinct().count() == 4
        monkeypatch.setattr(type(rows), "repartition", lambda *_: pytest.fail("landed rows are shuffled again"))
        assert tuple(land(Warehouse(spark, str(tmp_path)), rows, "a", "2024-01-01 00:00:00", ["pos"]).first()) == (900, 900, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files(Warehouse(spark, str(tmp_path)).raw())) == 4
