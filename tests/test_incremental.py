"""Marts kept load by load against a full rebuild."""

import random

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import member_sets
from tallyspark.operators import marts
from tallyspark.operators.staging import stage_transactions
from tallyspark.plans import incremental
from tallyspark.plans.incremental import IncrementalMarts
from tallyspark.sources.tables import Warehouse


def rebuilt(warehouse, name):
    staged = stage_transactions(warehouse.raw())
    build = getattr(marts, name)
    return build(staged if name == "dim_customers" else marts.fact_transactions(staged))


def rows_of(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(str(r[c]) for c in columns) for r in df.collect()))


def batch(raw_rows, seed, count, customer=None):
    rng = random.Random(seed)
    rows = [
        {
            "transaction_id": rng.choice([None, "", "T", "T"]) if rng.random() < 0.1 else f"T{rng.randrange(400)}",
            "customer_id": f"{customer or rng.randrange(6)}.0",
            "transaction_date": f"2024-0{rng.randrange(1, 9)}-11",
            "product_id": rng.choice([None, "P1", "P2", "P70000", "P40000"]),
            "product_name": rng.choice([None, "Product A", "Product B"]),
            "quantity": rng.choice([None, "1", "2.5", "7"]),
            "price": rng.choice(["10.5", "0", "0.0000000001", "x", "123456789012345.25"]),
            "tax": rng.choice([None, "1.005", "0"]),
        }
        for _ in range(count)
    ]
    return raw_rows(*rows)


@pytest.mark.parametrize("name", list(incremental.MARTS))
def test_equal_to_a_full_rebuild(spark, raw_rows, tmp_path, name):
    """After loads, a retry with other rows, an emptied load and a load nobody named."""
    warehouse = Warehouse(spark, str(tmp_path))
    kept = IncrementalMarts(warehouse, (name,))
    warehouse.append_raw(batch(raw_rows, 1, 150), "a")
    warehouse.append_raw(batch(raw_rows, 2, 60, customer=77), "b")
    kept.update("a", "b")
    assert rows_of(kept.table(name)) == rows_of(rebuilt(warehouse, name))
    warehouse.append_raw(batch(raw_rows, 3, 80), "b")
    warehouse.append_raw(batch(raw_rows, 4, 30, customer=88), "c")
    kept.update("b")
    assert rows_of(kept.table(name)) == rows_of(rebuilt(warehouse, name))
    warehouse.append_raw(batch(raw_rows, 4, 30).where("false"), "c")
    kept.update("c")
    assert rows_of(kept.table(name)) == rows_of(rebuilt(warehouse, name))
    assert kept.table(name).where("customer_id IN (77, 88)" if "customer_id" in kept.table(name).columns else "false").isEmpty()
    assert dict(kept.table(name).dtypes) == dict(rebuilt(warehouse, name).dtypes)


def test_only_touched_keys_are_merged_anew(spark, raw_rows, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    kept = IncrementalMarts(warehouse, ("dim_customers",))
    warehouse.append_raw(batch(raw_rows, 1, 100), "a")
    kept.update("a")
    merged = []
    whole = incremental.merge

    def spying(mart, totals, containers):
        merged.extend(r.customer_id for r in totals.select("customer_id").distinct().collect())
        return whole(mart, totals, containers)

    monkeypatch.setattr(incremental, "merge", spying)
    warehouse.append_raw(batch(raw_rows, 2, 60, customer=4), "b")
    kept.update("b")
    assert merged == [4]
    assert rows_of(kept.table("dim_customers")) == rows_of(rebuilt(warehouse, "dim_customers"))
    version = kept.manifest()["marts"]
    kept.update()
    assert kept.manifest()["marts"] == version


def test_a_run_that_breaks_off_changes_no_mart(spark, raw_rows, tmp_path, monkeypatch):
    """The second mart fails to be written: readers see both marts of the run before."""
    warehouse = Warehouse(spark, str(tmp_path))
    names = ("agg_by_customer_product", "dim_customers")
    kept = IncrementalMarts(warehouse, names)
    warehouse.append_raw(batch(raw_rows, 1, 50), "a")
    kept.update("a")
    open_before = kept.tables()
    before = {name: rows_of(df) for name, df in open_before.items()}
    warehouse.append_raw(batch(raw_rows, 9, 50, customer=5), "a")
    write = IncrementalMarts._write_mart

    def breaks(self, name, *args):
        if name == "dim_customers":
            raise RuntimeError("lost")
        return write(self, name, *args)

    with monkeypatch.context() as broken:
        broken.setattr(IncrementalMarts, "_write_mart", breaks)
        with pytest.raises(RuntimeError):
            kept.update("a")
    assert {name: rows_of(df) for name, df in kept.tables().items()} == before
    # Repeated, it also drops the keys of the attempt that was published.
    kept.update("a")
    for name in names:
        assert rows_of(kept.table(name)) == rows_of(rebuilt(warehouse, name))
    # Who read the run before still can.
    assert {name: rows_of(df) for name, df in open_before.items()} == before


def test_no_loads(spark, tmp_path):
    kept = IncrementalMarts(Warehouse(spark, str(tmp_path)), ("agg_by_product",))
    kept.update()
    assert kept.table("agg_by_product").count() == 0


def test_a_hot_set_is_kept_in_bounded_containers(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 4 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 90_000 - 100).cast("int").alias("v"),
    )
    halves = [member_sets.containers(rows.where(f"id % 2 = {k}"), ["k"], {"s": "v"}) for k in (0, 1)]
    whole = member_sets.union(halves[0].unionByName(halves[1]), ["k"])
    assert whole.where("k = 'hot'").agg(F.max(F.size("members")), F.count("*")).first()[0] <= 32_768
    hot = whole.where("k = 'hot'").groupBy("k").agg(
        member_sets.size_of("s").alias("n"), member_sets.members_of("s").alias("m"), member_sets.size_of("t").alias("none")
    ).first()
    expected = sorted({k % 90_000 - 100 for k in range(200_000) if k % 4})
    assert hot.m == expected and hot.n == len(expected) and hot.none == 0
