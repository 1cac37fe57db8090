import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyspark.operators import landing
from tallyspark.plans.daily_run import land
from tallyspark.sources.tables import Warehouse


def ids(df, other="product_name"):
    return sorted(((r.transaction_id, r[other]) for r in df.collect()), key=str)


def t(id_, name):
    return {"transaction_id": id_, "product_name": name}


def test_first_wins_and_rows_without_id_stay(raw_rows):
    batch = raw_rows(t("T1", "x"), t("T1", "y"), t(None, "n"), t(None, "n"), t("T2", "z"), t("1", "w"))
    landed = landing.first_wins(batch, ["pos"])
    assert ids(landed) == sorted(
        [("T1", "x"), ("T2", "z"), (None, "n"), (None, "n"), ("1", "w")], key=str
    )


def test_empty_text_is_an_id(raw_rows):
    landed = landing.first_wins(raw_rows(t("", "a"), t("", "b")), ["pos"])
    assert ids(landed) == [("", "a")]


def test_second_load_adds_only_rows_without_id(raw_rows):
    batch = raw_rows(t("T1", "x"), t("T1", "y"), t(None, "n"), t("T2", "z"))
    first = landing.land_batch(batch, None, ["pos"])
    second = landing.land_batch(batch, first, ["pos"])
    assert ids(second) == [(None, "n")]


def test_existing_row_wins(raw_rows):
    stored = raw_rows(t("T1", "old"), t(None, "n"))
    new = landing.land_batch(raw_rows(t("T1", "new"), t("T3", "c"), t(None, "n")), stored, ["pos"])
    assert ids(new) == sorted([("T3", "c"), (None, "n")], key=str)


def test_hot_id_and_many_rows_without_id(spark, raw_rows):
    """A third of the rows share an id, a third have none: brute force agrees."""
    base = spark.range(0, 30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "T1")
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("T"), (F.col("id") % 7000).cast("string")))
        .alias("transaction_id"),
        F.col("id").alias("pos"),
    )
    got = landing.first_wins(base, ["pos"]).collect()
    rows = base.collect()
    first = {}
    for r in rows:
        if r.transaction_id is not None:
            first[r.transaction_id] = min(r.pos, first.get(r.transaction_id, r.pos))
    assert {(r.transaction_id, r.pos) for r in got if r.transaction_id} == set(first.items())
    assert sorted(r.pos for r in got if r.transaction_id is None) == sorted(
        r.pos for r in rows if r.transaction_id is None
    )


def test_rows_without_id_spread_over_partitions(spark):
    """The shuffle key differs among rows without id, in the window and in the join."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.range(8000).select(
            F.lit(None).cast("string").alias("transaction_id"), F.col("id").alias("pos")
        )
        target = spark.range(10).select(F.col("id").cast("string").alias("transaction_id"))
        landed = landing.land_batch(batch, target, ["pos"])
        sizes = [r["count"] for r in landed.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 8000
    assert len(sizes) == 4 and max(sizes) < 3000


def test_load_metrics(raw_rows):
    batch = raw_rows(t("T1", "x"), t("T1", "y"), t(None, "n"))
    row = landing.load_metrics(batch, landing.land_batch(batch, None, ["pos"])).first()
    assert (row.rows_read, row.rows_inserted, row.rows_skipped) == (3, 2, 1)


def test_metrics_of_an_empty_batch(raw_rows):
    batch = raw_rows(t("T1", "x")).where("false")
    row = landing.load_metrics(batch, batch).first()
    assert (row.rows_read, row.rows_inserted, row.rows_skipped) == (0, 0, 0)


def test_lengths(raw_rows):
    fits = raw_rows({"transaction_id": "T" * 50, "product_name": "n" * 100, "tax": "1" + " " * 60})
    row = landing.enforce_lengths(fits).first()
    assert row.tax == "1" + " " * 49
    wide = raw_rows({"transaction_id": "T" * 51}, {"transaction_id": "ok"}, {})
    with pytest.raises(PySparkException, match="too long for transaction_id"):
        landing.enforce_lengths(wide).collect()
    fitting, rejected = landing.split_by_length(wide)
    assert (fitting.count(), rejected.count()) == (2, 1)
    report = {r.column_name: r.too_long for r in landing.length_report(wide).collect()}
    assert report["transaction_id"] == 1 and sum(report.values()) == 1


def test_land_into_a_warehouse(spark, raw_rows, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert warehouse.raw().count() == 0
    batch = raw_rows(t("T1", "x"), t("T1", "y"), t(None, "n"))
    metrics = land(warehouse, batch, "day-1", "2024-01-01 00:00:00", ["pos"]).first()
    assert tuple(metrics) == (3, 2, 1)
    # A retry of the same load replaces it, even at another moment.
    again = land(warehouse, batch, "day-1", "2024-01-01 00:05:00", ["pos"]).first()
    assert tuple(again) == (3, 2, 1)
    assert warehouse.raw().count() == 2
    # The same file on the next day adds the row without id.
    next_day = land(warehouse, batch, "day-2", "2024-01-02 00:00:00", ["pos"]).first()
    assert tuple(next_day) == (3, 1, 2)
    assert ids(warehouse.raw()) == sorted([("T1", "x"), (None, "n"), (None, "n")], key=str)
    assert warehouse.raw().select("loaded_at").distinct().count() == 2


def test_an_empty_retry_removes_its_load(spark, raw_rows, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    wrong = raw_rows(t("T1", "wrong"), t(None, "n"))
    land(warehouse, wrong, "day/1 ä", "2024-01-01 00:00:00", ["pos"])
    land(warehouse, raw_rows(t("T2", "x")), "day-2", "2024-01-02 00:00:00", ["pos"])
    metrics = land(warehouse, wrong.where("false"), "day/1 ä", "2024-01-01 00:05:00", ["pos"]).first()
    assert tuple(metrics) == (0, 0, 0)
    assert ids(warehouse.raw()) == [("T2", "x")]
    # The id is free again.
    metrics = land(warehouse, raw_rows(t("T1", "right")), "day-3", "2024-01-03 00:00:00", ["pos"]).first()
    assert tuple(metrics) == (1, 1, 0)
    assert ids(warehouse.raw()) == [("T1", "right"), ("T2", "x")]


def test_a_retry_of_which_everything_is_stored_elsewhere(spark, raw_rows, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    land(warehouse, raw_rows(t("T1", "x")), "day-1", "2024-01-01 00:00:00", ["pos"])
    land(warehouse, raw_rows(t("T2", "y")), "day-2", "2024-01-02 00:00:00", ["pos"])
    again = land(warehouse, raw_rows(t("T1", "z")), "day-2", "2024-01-02 00:05:00", ["pos"]).first()
    assert tuple(again) == (1, 0, 1)
    assert ids(warehouse.raw()) == [("T1", "x")]


def test_the_first_load_may_be_empty(spark, raw_rows, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    empty = raw_rows(t("T1", "x")).where("false")
    assert tuple(land(warehouse, empty, "day-1", "2024-01-01 00:00:00", ["pos"]).first()) == (0, 0, 0)
    assert warehouse.raw().count() == 0


def test_the_id_map_keeps_all_shared_ids(spark):
    batch = spark.range(0, 40_000, 2).select(F.concat(F.lit("T"), "id").alias("transaction_id"))
    target = spark.range(0, 40_000, 3).select(F.concat(F.lit("T"), "id").alias("transaction_id"))
    kept = {r.transaction_id for r in landing._perhaps_in(target, batch).collect()}
    shared = {f"T{k}" for k in range(0, 40_000, 6)}
    assert shared <= kept and len(kept) < len(shared) * 1.01


def test_overlong_row_leaves_raw_untouched(spark, raw_rows, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    land(warehouse, raw_rows(t("T1", "x")), "day-1", "2024-01-01 00:00:00", ["pos"])
    with pytest.raises(PySparkException):
        land(warehouse, raw_rows(t("T2", "n" * 101)), "day-2", "2024-01-02 00:00:00", ["pos"])
    assert ids(warehouse.raw()) == [("T1", "x")]
