"""Streaming landing against batch landing of the same files."""

import pytest

from tallyspark.plans.daily_run import land
from tallyspark.schemas import RAW_COLUMNS
from tallyspark.sources.csv_source import read_batch
from tallyspark.sources.tables import Warehouse
from tallyspark.streaming.landing_stream import land_stream

HEADER = ",".join(RAW_COLUMNS) + "\n"


def write(folder, name, *ids):
    lines = [f"{i},1.0,2023-07-15,P1,{name} {n},1,1,1\n" for n, i in enumerate(ids)]
    (folder / name).write_text(HEADER + "".join(lines))


def content(warehouse):
    return sorted(
        ((r.transaction_id, r.product_name) for r in warehouse.raw().collect()), key=str
    )


def test_stream_equals_batch(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    streamed = Warehouse(spark, str(tmp_path / "streamed"))
    batched = Warehouse(spark, str(tmp_path / "batched"))
    months = {"m1.csv": ["T1", "T2", "", "T1"], "m2.csv": ["T2", "T3", ""], "m3.csv": ["T3", "T4"]}
    for i, (name, ids) in enumerate(months.items()):
        write(files, name, *ids)
        land_stream(streamed, str(files), str(tmp_path / "cp"), name="m").awaitTermination()
        land(batched, read_batch(spark, str(files / name)), f"m{i}", "2024-01-01 00:00:00")
        assert content(streamed) == content(batched)
    # Two rows without id; of T1..T4 the first file wins.
    assert len(content(streamed)) == 6
    assert ("T3", "m2.csv 1") in content(streamed)


def test_nothing_new_adds_nothing(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    write(files, "a.csv", "T1", "")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    for _ in range(2):
        land_stream(warehouse, str(files), str(tmp_path / "cp")).awaitTermination()
    assert len(content(warehouse)) == 2


def test_one_file_at_a_time(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    write(files, "a.csv", "T1", "T2", "")
    write(files, "b.csv", "T2", "T3", "")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    land_stream(warehouse, str(files), str(tmp_path / "cp"), max_files=1).awaitTermination()
    got = content(warehouse)
    assert sorted(i for i, _ in got if i) == ["T1", "T2", "T3"]
    assert sum(1 for i, _ in got if i is None) == 2


def test_replay_without_rows_removes_its_partition(spark, tmp_path):
    """The file of a micro-batch is corrected to an empty one before it is delivered again."""
    files = tmp_path / "files"
    files.mkdir()
    write(files, "a.csv", "T1", "")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    land_stream(warehouse, str(files), str(tmp_path / "cp1")).awaitTermination()
    write(files, "a.csv")
    land_stream(warehouse, str(files), str(tmp_path / "cp2")).awaitTermination()
    assert content(warehouse) == []


def test_blank_lines_stop_the_stream(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    write(files, "a.csv", "T1")
    with (files / "a.csv").open("a") as file:
        file.write("\n\n")
    with pytest.raises(Exception, match="blank line in"):
        land_stream(Warehouse(spark, str(tmp_path / "w")), str(files), str(tmp_path / "cp")).awaitTermination()


def test_replayed_batch_replaces_its_partition(spark, tmp_path):
    """A micro-batch that is delivered twice must not double rows without id."""
    files = tmp_path / "files"
    files.mkdir()
    write(files, "a.csv", "T1", "", "")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    land_stream(warehouse, str(files), str(tmp_path / "cp1")).awaitTermination()
    # A lost checkpoint delivers batch 0 of the same stream again.
    land_stream(warehouse, str(files), str(tmp_path / "cp2")).awaitTermination()
    assert len(content(warehouse)) == 3
