"""Records over lines and blocks, against Python's own CSV reader."""

import csv
import io
import random

import pytest

from tallyspark.schemas import RAW_COLUMNS
from tallyspark.sources import csv_lines, csv_source

HEADER = ",".join(RAW_COLUMNS) + "\n"


@pytest.fixture
def split(spark):
    """Read files in parts of that many bytes."""

    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield of
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def random_rows(count, seed):
    """Rows with quotes, commas and line breaks in any number, some longer than a block."""
    rng = random.Random(seed)
    texts = ["a", "", "x,y", 'say "hi"', "\n", "\n\n", '"', '"\n"', ",\n,", "é\r\nz", "line\n" * 40, '",\n"' * 30]
    return [[f"T{i}", *[rng.choice(texts) for _ in range(7)]] for i in range(count)]


def as_csv(rows):
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("size", [700, 10_000_000])
def test_any_split_gives_the_same_rows_in_order(spark, tmp_path, split, size):
    files = {"a.csv": random_rows(20, 1), "b.csv": random_rows(10, 2), "c.csv": [], "d.csv": random_rows(1, 3)}
    for name, rows in files.items():
        (tmp_path / name).write_bytes((HEADER + as_csv(rows)).encode())
    split(size)
    batch = csv_source.read_batch(spark, str(tmp_path), multi_line=True)
    got = batch.orderBy(*csv_source.FILE_POSITION).collect()
    assert [list(r)[:8] for r in got] == [row for rows in files.values() for row in rows]
    assert len({tuple(r)[8:] for r in got}) == len(got)


def test_blocks_are_settled_in_file_order(spark, tmp_path, split):
    """Quotes inside a field do not count, and blocks without any pass the state on."""
    rows = ['T1,1,d,P1,5" pipe,1,1,1', 'T2,1,d,P1,"open', *["plain, with commas"] * 100, 'end",1,1,1', "T3,1,d,P1,x,1,1,1"]
    (tmp_path / "a.csv").write_text(HEADER + "\n".join(rows) + "\n")
    split(200)
    lines = csv_lines.with_place(spark.read.option("lineSep", "\n").text(str(tmp_path)))
    states = csv_lines.block_states(csv_lines.numbered(lines, follow=True)).collect()
    assert len(states) > 5 and len({(s.from_block, s.from_seq) for s in states}) == 1
    got = csv_source.read_batch(spark, str(tmp_path), multi_line=True).orderBy(*csv_source.FILE_POSITION).collect()
    assert [r.transaction_id for r in got] == ["T1", "T2", "T3"]
    assert got[0].product_name == '5" pipe'
    assert got[1].product_name == "\n".join(["open", *["plain, with commas"] * 100, "end"])


def test_one_large_record_among_many_blocks_keeps_the_rest_apart(spark, tmp_path, split):
    rows = [["T0", *["long\n" * 3000] + ["x"] * 6], *random_rows(20, 4)]
    (tmp_path / "a.csv").write_bytes((HEADER + as_csv(rows)).encode())
    split(4000)
    got = csv_source.read_batch(spark, str(tmp_path), multi_line=True).orderBy(*csv_source.FILE_POSITION).collect()
    assert [list(r)[:8] for r in got] == rows


def test_a_header_may_span_lines_and_windows_line_ends_are_cut(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'"a\nb",b,c,d,e,f,g,h\r\n1,2,3,4,5,6,7,8\r\n1,2,3,4,"5\r\n",6,7,"8"\r\n')
    rows = csv_source.read_batch(spark, str(tmp_path), multi_line=True).orderBy("row_seq").collect()
    assert [list(r)[:8] for r in rows] == [list("12345678"), ["1", "2", "3", "4", "5\r\n", "6", "7", "8"]]


@pytest.mark.parametrize(
    "text, complaint",
    [
        ('1,2,3,4,5,6,7,"8\n9\n', "quote without end"),
        ("1,2,3,4,5,6,7,8\r1,2,3,4,5,6,7,8\n", "carriage return"),
        ("1,2,3,4,5,6,7,8\n \n", "blank line"),
    ],
)
def test_what_is_no_record_stops_the_load_or_is_told_apart(spark, tmp_path, text, complaint):
    (tmp_path / "a.csv").write_bytes((HEADER + "0,2,3,4,5,6,7,8\n" + text).encode())
    path = str(tmp_path)
    with pytest.raises(Exception, match=f"malformed row: {complaint}"):
        csv_source.read_batch(spark, path, multi_line=True).count()
    rows = csv_source.read_with_rejects(spark, path, multi_line=True).collect()
    assert [r.transaction_id for r in rows if r.corrupt_record is None][0] == "0"
    assert sum(r.corrupt_record is not None for r in rows) == 1
    assert all(r.transaction_id is None for r in rows if r.corrupt_record)


def test_files_are_read_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "1,2,3,4,5,6,7,8\n")
    plan = csv_source.read_batch(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("text") >= 1 and plan.count("Relation [") == 1 and plan.count("from_csv") == 1


def test_no_files_hold_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("\n".join(["", HEADER.strip()]) + "\n")
    assert csv_source.read_batch(spark, str(tmp_path / "a.csv")).count() == 0
    assert csv_source.read_batch(spark, str(tmp_path / "a.csv"), multi_line=True).count() == 0
    with pytest.raises(Exception, match="blank line"):
        csv_source.read_batch(spark, str(tmp_path / "b.csv")).count()


@pytest.mark.parametrize(
    "line, begins, inside",
    [
        (b"a,b", False, True),
        (b'a,"b', True, False),
        (b'a,"b"', False, False),
        (b'a"b', False, False),
        (b'a,""', False, True),
        (b'"', True, False),
        (b'""', False, True),
        (b'"""', True, False),
        (b'x",y,"z', True, True),
        (b'"a"b,"c', True, True),
        (b"", False, True),
    ],
)
def test_state_behind_a_line(line, begins, inside):
    """Begun outside quotes, then begun inside quotes."""
    assert csv_lines.opens(line) == begins
    assert csv_lines.stays_open(line) == inside
