import pytest

from tallyspark.operators import landing
from tallyspark.schemas import RAW_COLUMNS
from tallyspark.sources import csv_source

HEADER = ",".join(RAW_COLUMNS) + "\n"


def write(path, *lines):
    path.write_text(HEADER + "".join(line + "\n" for line in lines), encoding="utf-8")
    return str(path)


def test_quotes_nulls_and_spaces(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'T1,,2023-07-15,P1,"x ""q"", y","", 3 ,é')
    row = csv_source.read_transactions(spark, path).first()
    assert tuple(row) == ("T1", None, "2023-07-15", "P1", 'x "q", y', "", " 3 ", "é")


def test_columns_go_by_position(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a,b,c,d,e,f,g,h\n1,2,3,4,5,6,7,8\n")
    row = csv_source.read_transactions(spark, str(path)).first()
    assert row.transaction_id == "1" and row.tax == "8"


@pytest.mark.parametrize("line", ["1,2,3", "1,2,3,4,5,6,7,8,9"])
def test_wrong_number_of_fields_stops_the_load(spark, tmp_path, line):
    path = write(tmp_path / "a.csv", "1,2,3,4,5,6,7,8", line)
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_source.read_batch(spark, path).collect()


def test_rejects_are_told_apart(spark, tmp_path):
    path = write(tmp_path / "a.csv", "1,2,3,4,5,6,7,8", "1,2", "1,2,3,4,5,6,7,8,9")
    rows = csv_source.read_with_rejects(spark, path).collect()
    assert sorted(r.corrupt_record for r in rows if r.corrupt_record) == ["1,2", "1,2,3,4,5,6,7,8,9"]


@pytest.mark.parametrize("blank", ["", "  "])
def test_blank_lines_stop_the_load(spark, tmp_path, blank):
    path = write(tmp_path / "a.csv", "1,2,3,4,5,6,7,8", blank, "2,2,3,4,5,6,7,8")
    with pytest.raises(Exception, match="blank line in"):
        csv_source.read_batch(spark, path).collect()
    with pytest.raises(Exception, match="blank line in"):
        csv_source.read_batch(spark, path).count()
    with pytest.raises(Exception, match="blank line in"):
        csv_source.read_transactions(spark, path, multi_line=True).collect()
    rejected = [r.corrupt_record for r in csv_source.read_with_rejects(spark, path).collect()]
    assert sorted(rejected, key=str) == sorted([None, None, blank], key=str)


def test_blank_lines_inside_quotes_are_text(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'T1,1,2023-07-15,P1,"a\n\n""b""",1,1,1')
    row = csv_source.read_transactions(spark, path, multi_line=True).first()
    assert row.product_name == 'a\n\n"b"'


def test_undecodable_text_stops_the_load(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes((HEADER + "T1,1,2023-07-15,P1,caf").encode() + b"\xe9,1,1,1\n")
    for read in (csv_source.read_batch, csv_source.read_transactions, csv_source.read_with_rejects):
        with pytest.raises(Exception, match="INVALID_UTF8_STRING"):
            read(spark, str(path)).collect()


def test_text_outside_ascii(spark, tmp_path):
    path = write(tmp_path / "a.csv", "T1,1,2023-07-15,P1,é 日本 🙂 \ufffd,1,1,1")
    assert csv_source.read_batch(spark, path).first().product_name == "é 日本 🙂 \ufffd"


def test_counting_rows_sees_malformed_ones(spark, tmp_path):
    path = write(tmp_path / "a.csv", "1,2,3,4,5,6,7,8", "1,2,3")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_source.read_batch(spark, path).count()
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_source.read_transactions(spark, path).select("tax").collect()


def test_line_break_in_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'T1,1,2023-07-15,P1,"a\nb",1,1,1')
    assert csv_source.read_transactions(spark, path, multi_line=True).first().product_name == "a\nb"


def test_first_file_wins_although_the_second_is_larger(spark, tmp_path):
    """Scan tasks start with large files; the order of names must still hold."""
    write(tmp_path / "a.csv", "T1,,,,first,,,")
    write(tmp_path / "b.csv", "T1,,,,second,,,", *[f"X{i},,,,filler,,," for i in range(5000)])
    batch = csv_source.read_batch(spark, str(tmp_path))
    landed = landing.first_wins(batch, csv_source.FILE_POSITION)
    assert landed.where("transaction_id = 'T1'").first().product_name == "first"
    assert landed.count() == 5001


def test_first_row_wins_across_parts_of_one_file(spark, tmp_path):
    path = write(tmp_path / "a.csv", *[f"T{i % 500},,,,row {i:06d},,," for i in range(20_000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        batch = csv_source.read_batch(spark, path)
        assert batch.rdd.getNumPartitions() > 4
        names = landing.first_wins(batch, csv_source.FILE_POSITION).select("product_name").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(r.product_name for r in names) == [f"row {i:06d}" for i in range(500)]


def test_round_trip(spark, raw_rows, tmp_path):
    rows = raw_rows({"product_name": 'a "b", c', "tax": ""}, {"price": " 1 "})
    path = str(tmp_path / "out")
    csv_source.write_transactions(rows, path)
    back = csv_source.read_transactions(spark, path).collect()
    assert sorted(map(str, back)) == sorted(map(str, rows.select(*RAW_COLUMNS).collect()))
