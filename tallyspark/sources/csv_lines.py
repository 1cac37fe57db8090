"""Records of CSV files out of their lines, which any split of the files may part.

Spark's CSV reader passes over blank lines and, for line breaks inside quotes, makes a file one
task. Here files are read as lines, once. Quoted text may go on over lines, blocks of a file
and whole tasks, so a line alone does not tell whether it begins a record. A task therefore
follows two cases through its block: that the block begins a record, and that it lies inside
quotes. Each block is then a function of one bit; windows over one row per block compose them
in file order, which settles every block. Only lines of records that span lines are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.session import materialize

BLOCK = ("file_path", "file_block_start")
# A row's place in the load: files by name, parts of a file by offset, then lines.
FILE_POSITION = (*BLOCK, "row_seq")

_LINES = "value binary, file_path string, file_block_start bigint, row_seq bigint, is_header boolean"
_CASES = ("record_if_out bigint, open_if_out boolean", "record_if_in bigint, open_if_in boolean")

# The quote that opens a field stands at its beginning; behind a closing one, text up to the
# next comma belongs to the field.
_QUOTED = rb'"[^"]*+(?:""[^"]*+)*+'
_OPENS = re.compile(rb'(?:(?:%b"[^,]*+|(?!")[^,]*+),)*+%b\Z' % (_QUOTED, _QUOTED))
_CLOSES = re.compile(rb'[^"]*+(?:""[^"]*+)*+"[^,]*+')

# Spark's CSV reader takes characters up to the space for blank.
_BLANK = r"\A[\x00-\x20]*\z"


def opens(line: bytes) -> bool:
    """Whether a line that begins a record leaves a quote open."""
    return b'"' in line and _OPENS.match(line) is not None


def stays_open(line: bytes) -> bool:
    """Whether a line that begins inside quotes ends inside quotes."""
    closing = _CLOSES.match(line)
    return closing is None or opens(line[closing.end() + 1 :])


class _Case:
    """One assumption about the beginning of a block, followed through its lines.

    ``record`` is the line that began the record at hand, -1 for one of an earlier block.
    """

    def __init__(self, inside: bool):
        self.open, self.record = inside, -1

    def follow(self, seq: np.ndarray, quoted: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Per line: the line that began its record, and whether the record goes on behind it."""
        record, more = seq.copy(), np.zeros(len(seq), bool)
        first = 0
        for i, line in quoted:
            if self.open:
                if not stays_open(line):
                    record[first : i + 1], more[first:i], self.open = self.record, True, False
            elif opens(line):
                self.open, self.record, first = True, seq[i], i
        if self.open:
            record[first:], more[first:] = self.record, True
        return record, more

    def agrees(self, other: _Case) -> bool:
        return self.open == other.open and (not self.open or self.record == other.record)


class _Block:
    """What a task remembers of the block it reads."""

    def __init__(self, key: tuple[str, int], header: bool, follow: bool):
        self.key, self.lines = key, 0
        self.header = -1
        self.seeks_header = header and key[1] == 0
        self.cases = (_Case(False), _Case(True)) if follow else ()

    def read(self, values: pa.Array) -> list[pa.Array]:
        seq = np.arange(self.lines, self.lines + len(values), dtype=np.int64)
        self.lines += len(values)
        for i in range(len(values) if self.seeks_header else 0):
            if values[i].as_py().strip(bytes(range(33))):
                self.header, self.seeks_header = int(seq[i]), False
                break
        if not self.cases:
            return [pa.array(seq), pa.array(seq == self.header)]
        places = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
        quoted = list(zip(places.tolist(), values.take(pa.array(places)).to_pylist(), strict=True))
        outside, inside = self.cases
        # Cases that agree once agree to the end of the block.
        same = outside.agrees(inside)
        record, more = outside.follow(seq, quoted)
        result = [pa.array(seq), pa.array(record == self.header if self.header >= 0 else np.zeros(len(seq), bool))]
        result += [pa.array(record), pa.array(more)]
        if same:
            inside.open, inside.record = outside.open, outside.record
        else:
            record, more = inside.follow(seq, quoted)
        return [*result, pa.array(record), pa.array(more)]


def _reader(names: list[str], header: bool, follow: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            path, start = batch.column("file_path"), batch.column("file_block_start")
            at = 0
            while at < batch.num_rows:
                key = (path[at].as_py(), start[at].as_py())
                if path[-1].as_py() == key[0] and start[-1].as_py() == key[1]:
                    end = batch.num_rows
                else:
                    same = pc.and_(pc.equal(path, key[0]), pc.equal(start, key[1])).to_numpy(zero_copy_only=False)
                    end = at + int(np.argmin(same[at:]))
                if block is None or block.key != key:
                    block = _Block(key, header, follow)
                part = batch.slice(at, end - at)
                columns = [part.column(name) for name in ("value", *BLOCK)]
                yield pa.RecordBatch.from_arrays([*columns, *block.read(columns[0])], names)
                at = end

    return read


def numbered(files: DataFrame, header: bool = True, follow: bool = False) -> DataFrame:
    """Lines of a text scan with their number in the block; also valid on a batch of a stream.

    ``is_header`` marks the first line of a file that is not blank. With ``follow`` the columns
    of both cases are added, and all lines of a header that spans lines are marked.
    """
    schema = ", ".join((_LINES, *(_CASES if follow else ())))
    names = [field.split()[0] for field in schema.split(", ")]
    lines = files.select(F.col("value").cast("binary").alias("value"), *BLOCK)
    return lines.mapInArrow(_reader(names, header, follow), schema)


def with_place(files: DataFrame) -> DataFrame:
    """The lines of a text scan with their block."""
    return files.select("value", *[F.col(f"_metadata.{name}").alias(name) for name in BLOCK])


def single_lines(files: DataFrame, header: bool = True) -> DataFrame:
    """(text, *FILE_POSITION, complaint): every line is a record."""
    lines = numbered(files, header).where("NOT is_header")
    return lines.select(_text().alias("text"), *FILE_POSITION, _blank_complaint().alias("complaint"))


def _text() -> Column:
    return F.col("value").cast("string")


def is_blank(text: Column) -> Column:
    return text.rlike(_BLANK)


def _blank_complaint() -> Column:
    return F.when(is_blank(_text()), F.lit("blank line"))


def block_states(lines: DataFrame) -> DataFrame:
    """(*BLOCK, from_block, from_seq) of the blocks that begin inside quotes, with the record's place.

    One row per block goes through the windows. A block leaves the bit as it is, turns it, or
    settles it; the bit before a block is what the last settling block gave, turned as often as
    blocks since then turn it. A file begins outside quotes.
    """
    ends = lines.groupBy(*BLOCK).agg(
        F.max_by(F.struct("record_if_out", "open_if_out", "record_if_in", "open_if_in"), "row_seq").alias("end")
    )
    of_file = Window.partitionBy("file_path").orderBy("file_block_start")
    so_far = of_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = of_file.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col("end.open_if_out") & ~F.col("end.open_if_in")
    settles = F.col("end.open_if_out") == F.col("end.open_if_in")
    turned = ends.withColumn("turns", F.sum(turns.cast("int")).over(so_far))
    settled = turned.withColumn(
        "base", F.last(F.when(settles, F.struct(F.col("end.open_if_out").alias("open"), "turns")), True).over(so_far)
    )
    since = F.col("turns") - F.coalesce("base.turns", F.lit(0))
    after = settled.withColumn("after", F.coalesce("base.open", F.lit(False)) != (since % 2 == 1))
    inside = after.withColumn("inside", F.coalesce(F.lag("after").over(of_file), F.lit(False)))
    last = F.when(F.col("inside"), F.col("end.record_if_in")).otherwise(F.col("end.record_if_out"))
    begun = F.when(
        F.col("after") & (last >= 0), F.struct(F.col("file_block_start").alias("block"), last.alias("seq"))
    )
    placed = inside.withColumn("begun", F.last(begun, True).over(earlier)).where("inside")
    return placed.select(*BLOCK, F.col("begun.block").alias("from_block"), F.col("begun.seq").alias("from_seq"))


def joined_lines(files: DataFrame, header: bool = True) -> DataFrame:
    """(text, *FILE_POSITION, complaint): records whose quoted text may hold line breaks.

    The files must be read with the line feed as separator, so that carriage returns inside
    quotes stay. The lines are written once; all else is read from there. A record lies in one
    row, so its lines meet in one task; a quote that is never closed makes the rest of its file
    one record with a complaint. Carriage returns alone do not end a line: outside quotes they
    are a complaint too.
    """
    lines = materialize(numbered(files, header, follow=True), "lines")
    states = block_states(lines)
    placed = lines.where("NOT is_header").join(states, [*BLOCK], "left")
    inside = F.col("from_block").isNotNull()
    earlier = inside & (F.col("record_if_in") < 0)
    placed = placed.select(
        "value",
        *FILE_POSITION,
        F.when(earlier, F.col("from_block")).otherwise(F.col("file_block_start")).alias("at_block"),
        F.when(earlier, F.col("from_seq"))
        .when(inside, F.col("record_if_in"))
        .otherwise(F.col("record_if_out"))
        .alias("at_seq"),
        F.when(inside, F.col("open_if_in")).otherwise(F.col("open_if_out")).alias("open"),
    )
    alone = (F.col("at_block") == F.col("file_block_start")) & (F.col("at_seq") == F.col("row_seq")) & ~F.col("open")
    pieces = F.array_sort(F.collect_list(F.struct("file_block_start", "row_seq", _text().alias("line"))))
    spanning = (
        placed.where(~alone)
        .groupBy("file_path", "at_block", "at_seq")
        .agg(
            F.array_join(F.transform(pieces, lambda p: p["line"]), "\n").alias("text"),
            F.max_by("open", F.struct("file_block_start", "row_seq")).alias("open"),
        )
        .select(
            "text",
            "file_path",
            F.col("at_block").alias("file_block_start"),
            F.col("at_seq").alias("row_seq"),
            F.when(F.col("open"), F.lit("quote without end")).alias("complaint"),
        )
    )
    single = placed.where(alone).select(_text().alias("text"), *FILE_POSITION, _blank_complaint().alias("complaint"))
    text = F.regexp_replace("text", r"\r\z", "")
    bare = F.regexp_replace(text, '"(?:[^"]|"")*+"', "q")
    stray = F.when(F.contains(text, F.lit("\r")) & F.contains(bare, F.lit("\r")), F.lit("carriage return"))
    whole = single.unionByName(spanning)
    return whole.select(text.alias("text"), *FILE_POSITION, F.coalesce("complaint", stray).alias("complaint"))
