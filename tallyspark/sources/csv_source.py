"""CSV batches of raw transactions: eight text columns by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.schemas import RAW_COLUMNS, RAW_CSV_SCHEMA
from tallyspark.sources import csv_lines
from tallyspark.sources.csv_lines import FILE_POSITION

CORRUPT = "corrupt_record"

# Fixed values. A doubled quote escapes a quote; an unquoted empty field is
# NULL and a quoted one is the empty string, which needs a null marker that no
# text holds; spaces are kept; a row with another number of fields is an error.
CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "\u0001",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "mode": "FAILFAST",
    # Pruned columns would hide a wrong number of fields.
    "columnPruning": "false",
}


def _lines(spark: SparkSession, paths: str | Sequence[str], multi_line: bool) -> DataFrame:
    reader = spark.read.option("lineSep", "\n") if multi_line else spark.read
    return csv_lines.with_place(reader.text(paths))


def _parsed(
    records: DataFrame, schema: T.StructType, options: dict[str, str], text: Column, *kept: str
) -> DataFrame:
    """Each record's text parsed once; bytes that are not UTF-8 stop the job.

    A generator keeps the parser out of later projections and in plans that need no columns.
    """
    fields = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema)
    row = F.from_csv(F.validate_utf8(text), fields, options)
    return records.select(*FILE_POSITION, *kept, F.inline(F.array(row)))


def parsed(records: DataFrame) -> DataFrame:
    """Raw columns and place of each record; a malformed one or a blank line stops the job."""
    complaint = F.concat(F.lit("malformed row: "), F.col("complaint"), F.lit(" in "), F.col("file_path"))
    text = F.when(F.col("complaint").isNull(), F.col("text")).otherwise(F.raise_error(complaint))
    rows = _parsed(records, RAW_CSV_SCHEMA, CSV_OPTIONS, text)
    return rows.select(*RAW_COLUMNS, *FILE_POSITION)


def read_batch(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False
) -> DataFrame:
    """Read a batch with ``FILE_POSITION``, unique per row and in file order.

    A malformed row, a blank line or text that is not UTF-8 stops the job. ``multi_line``
    allows line breaks inside quotes and writes the lines once more; files are split either way.
    """
    lines = _lines(spark, paths, multi_line)
    return parsed(csv_lines.joined_lines(lines) if multi_line else csv_lines.single_lines(lines))


def read_transactions(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False
) -> DataFrame:
    """Read the raw columns of a batch, as ``read_batch`` does."""
    return read_batch(spark, paths, multi_line).select(*RAW_COLUMNS)


def read_with_rejects(
    spark: SparkSession, paths: str | Sequence[str], header: bool = True, multi_line: bool = False
) -> DataFrame:
    """Read every row; malformed ones and blank lines carry their text in ``corrupt_record``."""
    schema = T.StructType([*RAW_CSV_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    options = {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = _lines(spark, paths, multi_line)
    records = csv_lines.joined_lines(lines, header) if multi_line else csv_lines.single_lines(lines, header)
    # What is refused is not parsed: it takes the place of a record with too few fields.
    text = F.when(F.col("complaint").isNull(), F.col("text")).otherwise(F.lit("?"))
    refused = F.when(F.col("complaint").isNotNull(), F.validate_utf8("text"))
    rows = _parsed(records.withColumn("refused", refused), schema, options, text, "refused")
    columns = [F.when(F.col("refused").isNull(), F.col(c)).alias(c) for c in RAW_COLUMNS]
    return rows.select(*columns, F.coalesce("refused", CORRUPT).alias(CORRUPT))


# How to write text that CSV_OPTIONS reads back unchanged.
CSV_WRITE_OPTIONS = {
    "escape": '"',
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_transactions(rows: DataFrame, path: str, compression: str | None = None) -> None:
    """Write raw rows as CSV files with a header; a packed file is read by one task."""
    columns = rows.select(*RAW_COLUMNS)
    columns.write.mode("overwrite").options(header="true", **CSV_WRITE_OPTIONS).csv(path, compression=compression)
