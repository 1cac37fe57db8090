import pytest
from pyspark.errors import AnalysisException

from tallyspark.operators.quality import DataQualityError
from tallyspark.plans.daily_run import run
from tallyspark.schemas import RAW_COLUMNS
from tallyspark.sources.tables import LAYER, Warehouse

HEADER = ",".join(RAW_COLUMNS) + "\n"
GOOD = [
    "T1,1.0,2023-07-15,P1,Product A,1.0,10.5,1.5",
    "T2,1.0,16-07-2023,P2,Product B,2.0,20,Fifteen",
    "T2,1.0,16-07-2023,P2,Product B,2.0,20,2",
    ",2.0,2023-07-15,P1,Product A,1.0,10.5,1.5",
    "T3,2.0,2023-07-17,P2,Product B,few,20,2",
    "T4,2.0,2023-07-17,P2,Product B,3,20,2",
]
BAD = [*GOOD, "T9,3.0,2023-07-18,P9,Product Z,1,1,1"]


def csv(tmp_path, lines):
    path = tmp_path / "batch.csv"
    path.write_text(HEADER + "\n".join(lines) + "\n")
    return str(path)


def test_run_builds_every_table(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    result = run(
        warehouse, csv(tmp_path, GOOD), "day-1", "2024-01-01 06:00:00", with_star=True
    )
    assert tuple(result.metrics.first()) == (6, 5, 1)
    assert result.checks.count() == 29
    counts = {name: warehouse.table(name).count() for name in LAYER}
    assert counts == {
        "dim_customers": 2,
        "dim_products": 2,
        "dim_date": 3,
        "fact_transactions": 2,
        "fact_star": 2,
        "agg_by_customer": 2,
        "agg_by_product": 2,
        "agg_by_customer_product": 2,
        "audit_errors_by_customer": 2,
        "audit_errors_by_load_date": 1,
    }
    assert spark.table("stg_customer_transactions").count() == 5
    array = warehouse.table("agg_by_customer").schema["product_ids"].dataType
    assert array.simpleString() == "array<int>"


def test_second_day(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    path = csv(tmp_path, GOOD)
    run(warehouse, path, "day-1", "2024-01-01 06:00:00")
    result = run(warehouse, path, "day-2", "2024-01-02 06:00:00")
    assert tuple(result.metrics.first()) == (6, 1, 5)
    assert warehouse.table("audit_errors_by_load_date").count() == 2


def test_failing_checks_stop_the_run_after_publishing(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(DataQualityError, match="product_name accepted_values: 1"):
        run(warehouse, csv(tmp_path, BAD), "day-1", "2024-01-01 06:00:00")
    assert warehouse.table("fact_transactions").count() == 3


def test_check_first_publishes_only_what_passes(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(DataQualityError):
        run(warehouse, csv(tmp_path, BAD), "day-1", "2024-01-01 06:00:00", check_first=True)
    with pytest.raises(AnalysisException):
        warehouse.table("fact_transactions")
    clean = Warehouse(spark, str(tmp_path / "clean"))
    run(clean, csv(tmp_path, GOOD), "day-1", "2024-01-01 06:00:00", check_first=True)
    assert clean.table("fact_transactions").count() == 2


def test_failed_checks_can_be_returned_unpublished(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    run(warehouse, csv(tmp_path, GOOD), "day-1", "2024-01-01 06:00:00")
    result = run(
        warehouse, csv(tmp_path, BAD), "day-2", "2024-01-02 06:00:00", check_first=True, stop_on_failure=False
    )
    assert result.checks.where("NOT passed").count() == 1
    assert warehouse.table("fact_transactions").count() == 2
    result = run(warehouse, csv(tmp_path, BAD), "day-2", "2024-01-02 06:00:00", stop_on_failure=False)
    assert result.checks.where("NOT passed").count() == 1
    assert warehouse.table("fact_transactions").count() == 3


def test_readers_never_miss_a_table(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    run(warehouse, csv(tmp_path, GOOD), "day-1", "2024-01-01 06:00:00")
    before = warehouse.table("fact_transactions")
    unseen = warehouse.write_version("fact_transactions", before.where("false"))
    assert warehouse.table("fact_transactions").count() == 2
    warehouse.publish({"fact_transactions": unseen})
    assert warehouse.table("fact_transactions").count() == 0
    # A reader that began before still has its files.
    assert before.count() == 2
    warehouse.overwrite("fact_transactions", before.limit(1))
    assert warehouse.table("fact_transactions").count() == 1
    versions = [p.name for p in (tmp_path / "w/analytics/fact_transactions").iterdir() if p.name.startswith("version")]
    assert len(versions) == 2


def test_the_raw_layer_is_cleaned_once_and_scratch_goes(spark, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    monkeypatch.setattr("tallyspark.session.shared_dir", lambda _: str(shared))
    scans = []
    real = Warehouse.raw
    monkeypatch.setattr(Warehouse, "raw", lambda self: scans.append(1) or real(self))
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    run(warehouse, csv(tmp_path, GOOD), "day-1", "2024-01-01 06:00:00")
    assert scans == [1]
    for table in warehouse.table("dim_customers"), warehouse.table("fact_transactions"):
        assert table.count() == 2
    assert not [p for p in shared.rglob("*") if p.is_file()]


def test_a_long_price_reaches_the_fact(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    lines = [*GOOD, "T8,1.0,2023-07-15,P1,Product A,3,123456789012345.0000000001,0.005"]
    run(warehouse, csv(tmp_path, lines), "day-1", "2024-01-01 06:00:00")
    row = warehouse.table("fact_transactions").where("transaction_id = 8").first()
    assert str(row.unit_price) == "123456789012345.0000000001"
    assert str(row.gross_amount) == "370370367037035.00" and str(row.total_amount) == "370370367037035.01"
    longer = [*GOOD, "T9,1.0,2023-07-15,P1,Product A,3,12345678901234567,1"]
    with pytest.raises(Exception, match="price: too many digits in '12345678901234567'"):
        run(warehouse, csv(tmp_path, longer), "day-2", "2024-01-02 06:00:00")


def test_strict_mode_stops_on_text_that_cannot_be_converted(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    path = csv(tmp_path, [*GOOD, "TX,1.0,2023-07-15,P1,Product A,1,1,1"])
    with pytest.raises(Exception, match="cannot convert 'TX'"):
        run(warehouse, path, "day-1", "2024-01-01 06:00:00", mode="strict")
    run(warehouse, path, "day-1", "2024-01-01 06:00:00")


def test_tables_of_a_run_change_together(spark, tmp_path, monkeypatch):
    """Publishing dies before the manifest is in place: readers see the run before, of every table."""
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    run(warehouse, csv(tmp_path, GOOD), "day-1", "2024-01-01 06:00:00")
    before = {name: df.count() for name, df in warehouse.snapshot().items()}
    held = warehouse.snapshot()

    def dies(*_):
        raise OSError("store is gone")

    with monkeypatch.context() as broken:
        broken.setattr("tallyspark.sources.tables.replace_text", dies)
        with pytest.raises(OSError):
            run(warehouse, csv(tmp_path, [*GOOD, "T8,9.0,2023-07-18,P9,Product A,1,1,1"]), "day-2", "2024-01-02 06:00:00")
    assert {name: df.count() for name, df in warehouse.snapshot().items()} == before
    run(warehouse, csv(tmp_path, [*GOOD, "T8,9.0,2023-07-18,P9,Product A,1,1,1"]), "day-2", "2024-01-02 06:00:00")
    after = {name: df.count() for name, df in warehouse.snapshot().items()}
    assert after["fact_transactions"] == before["fact_transactions"] + 1 and after["agg_by_customer"] == before["agg_by_customer"] + 1
    # A snapshot taken before still reads the run it was taken of.
    assert {name: df.count() for name, df in held.items()} == before
