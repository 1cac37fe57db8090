"""What a query leaves on disk while it runs: shuffle files, intermediate tables, and no part of its work."""

import os

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import landing, marts
from tallyspark.plans import daily_run
from tallyspark.plans import queries as catalog
from tallyspark.plans.queries import base
from tallyspark.plans.queries import landing as landing_queries
from tallyspark.schemas import RAW_COLUMNS
from tallyspark.session import Scratch, materialize, shared_dir, shuffles_deleted
from tallyspark.sources import id_index
from tallyspark.sources.csv_source import read_batch
from tallyspark.sources.tables import Warehouse

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@pytest.fixture
def staged(spark):
    """Transactions of one id under two customers and products, members that are NULL, and a row without tax."""
    rows = [
        (1, 7, 1, "A", "2.50", "0.10"),
        (1, 8, 1, "A", "2.50", "0.10"),
        (2, 7, 1, "A", "1.00", "0.20"),
        (2, 7, None, "A", "1.00", "0.20"),
        (3, 7, 2, "B", "4.00", None),
    ]
    text = spark.createDataFrame(rows, "t int, c int, p int, name string, price string, tax string")
    return text.select(
        F.col("t").alias("transaction_id"),
        F.col("c").alias("customer_id"),
        F.col("p").alias("product_id"),
        F.col("name").alias("product_name"),
        F.lit("2024-01-31").cast("date").alias("transaction_date"),
        F.lit(2).alias("quantity"),
        F.col("price").cast("decimal(26,10)"),
        F.col("tax").cast("decimal(26,10)"),
        F.lit(True).alias("is_valid"),
        F.lit("2024-01-31 06:00:00").cast("timestamp_ntz").alias("loaded_at"),
    )


@pytest.fixture
def tables(spark, tmp_path):
    spark.sql("""SELECT 1L l_orderkey, 1 l_linenumber, 1L l_partkey, 1L l_suppkey, TIMESTAMP '1998-01-02' l_shipdate,
        1D l_quantity, 2D l_extendedprice, 0.5D l_tax""").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT 1L o_orderkey, 5L o_custkey, TIMESTAMP '1998-01-01' o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT 1L p_partkey, 901.5D p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_both_builds_write_the_whole_fact(spark, staged, monkeypatch):
    """the first of the two builds left out small quantities."""
    monkeypatch.setattr(landing_queries, "fact", lambda *_: marts.fact_transactions(staged))
    written = []
    overwrite = Warehouse.overwrite

    def spying(self, name, df):
        written.append(df.count())
        return overwrite(self, name, df)

    monkeypatch.setattr(Warehouse, "overwrite", spying)
    assert landing_queries.table_overwrite_sink(spark, "").count() == 4
    assert written == [4, 4]


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}


def test_written_tables_leave_no_shuffle_files(spark):
    rows = spark.range(1000).groupBy((F.col("id") % 9).alias("k")).count()
    before = shuffle_files(spark)
    written = materialize(rows, "packed")
    assert shuffle_files(spark) <= before
    with Scratch(spark) as scratch:
        assert len(scratch.materialize(rows, "packed").repartition(3).groupBy("k").count().collect()) == 9
    assert shuffle_files(spark) <= before and len(written.collect()) == 9


def test_cleanup_setting_comes_back(spark):
    former = spark.conf.get(CLEANUP, None)
    with shuffles_deleted(spark), shuffles_deleted(spark):
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP, None) == former
    spark.conf.set(CLEANUP, "true")
    with pytest.raises(ZeroDivisionError), shuffles_deleted(spark):
        1 // 0
    assert spark.conf.get(CLEANUP) == "true"
    spark.conf.unset(CLEANUP)


def test_landed_rows_win_as_numbers(spark, tables):
    rows = base.landed(spark, tables)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Product ") < plan.index("Window [")
    assert tuple(rows.first())[:4] == ("T11", "5.0", "1998-01-01", "P1")


def shared_names(spark):
    """Tables and folders below the shared one."""
    folder = f"{shared_dir(spark)}/tallyspark"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def labels(names):
    return sorted(name.rsplit("-", 1)[0] for name in names)


@pytest.mark.parametrize("name", ["dim_customers", "agg_by_customer", "agg_by_customer_product"])
def test_stored_marts_leave_no_landing(spark, tables, name):
    before, files = shared_names(spark), shuffle_files(spark)
    mart = catalog.queries()[f"incremental_{name}"](spark, tables)
    assert shuffle_files(spark) <= files
    assert labels(shared_names(spark) - before) == ["incremental"]
    assert [(r.customer_id, r.total_transactions) for r in mart.collect()] == [(5, 1)]


def test_suite_leaves_no_landing(spark, tables):
    before, files = shared_names(spark), shuffle_files(spark)
    report = catalog.queries()["dq_suite"](spark, tables)
    assert shuffle_files(spark) <= files
    assert not {"landed", "run"} & {*labels(shared_names(spark) - before)}
    assert {r.failures for r in report.collect()} == {0} and report.count() == 29


def test_stream_leaves_no_shuffles(spark, tables):
    files = shuffle_files(spark)
    assert catalog.queries()["landing_stream"](spark, tables).collect()[0].transaction_id == "T11"
    assert shuffle_files(spark) <= files


def test_landed_files_go_by_number(spark, tmp_path, monkeypatch):
    """Twelve files, the first by name wins; their paths are not shuffled."""
    (tmp_path / "files").mkdir()
    for n in range(12):
        lines = [",".join(RAW_COLUMNS), f"T1,1.0,2023-07-15,P1,file {n},1,1,1", f",1.0,2023-07-15,P1,file {n},1,1,1"]
        (tmp_path / "files" / f"{n}.csv").write_text("\n".join(lines) + "\n")
    seen = []
    slotted = landing.land_slotted

    def spying(batch, target, position):
        seen.append((batch.columns, tuple(position)))
        return slotted(batch, target, position)

    monkeypatch.setattr(landing, "land_slotted", spying)
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    batch = read_batch(spark, str(tmp_path / "files")).where("product_name <> 'file 0'")
    assert tuple(daily_run.land(warehouse, batch, "a", "2024-01-01 00:00:00").first()) == (22, 12, 10)
    assert [r.product_name for r in warehouse.raw().where("transaction_id = 'T1'").collect()] == ["file 1"]
    (columns, position), = seen
    assert "file_path" not in columns and position[1:] == ("file_block_start", "row_seq")
    # Among these, 10 and 11 come before 2.
    later = read_batch(spark, str(tmp_path / "files")).where("product_name NOT IN ('file 0', 'file 1')")
    daily_run.land(warehouse, later, "a", "2024-01-01 00:00:00")
    assert [r.product_name for r in warehouse.raw().where("transaction_id = 'T1'").collect()] == ["file 10"]


def test_bits_are_found_in_words(spark):
    """Every bit of a bitmap, set and not set, in the words that a look-up reads in place."""
    places = spark.range(1 << 15).withColumnRenamed("id", "place")
    is_set = F.col("place") * 37 % 101 < 30
    whole = places.groupBy().agg(F.bitmap_construct_agg(F.when(is_set, F.col("place"))).alias("map"))
    words = whole.select(id_index._words("map").alias("words"))
    looked_up = places.crossJoin(F.broadcast(words)).select("place", id_index._is_set("words", F.col("place")).alias("got"), is_set.alias("set"))
    assert looked_up.where("got <> set").count() == 0 and looked_up.where("set").count() > 9000


def test_look_ups_do_not_copy_bitmaps(spark):
    """A join with maps as binary columns copies all eight of them for each id."""
    rows = spark.range(9).select(F.concat(F.lit("T"), "id").alias("transaction_id"), F.lit(0).cast("long").alias("id_bucket"))
    index = id_index.build(rows, 1, 1).withColumn("load_id", F.lit("a"))
    plan = id_index.hits(index, rows)._jdf.queryExecution().optimizedPlan()
    joins = [line for line in plan.toString().splitlines() if "Join" in line]
    assert joins and "getbit" in joins[0] and "substring(map" not in joins[0]
    assert [tuple(r) for r in id_index.hits(index, rows).collect()] == [("a", 0)]


def test_indexed_landing_leaves_no_copies(spark, tables):
    before, files = shared_names(spark), shuffle_files(spark)
    catalog.queries()["landing_indexed"](spark, tables)
    assert labels(shared_names(spark) - before) == ["indexed"]
    assert shuffle_files(spark) <= files
