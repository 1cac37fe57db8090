"""WARC archives: written as gzip members, read back by byte ranges.

Writing: each task writes one archive below a shared folder under a name of its own and
returns (path, bytes, records). Only archives listed in the written manifest count, so
what a lost or repeated task left behind is never read.

Reading: a task takes byte ranges. It scans for the gzip magic, accepts a candidate if it
inflates to a WARC header, and owns the records that start inside its range, reading past
the end of the range where a record does. Archives may come from anywhere; a member that
holds another, stored archive uncompressed is the one layout that scanning cannot tell
apart.

Foreign records: a stated payload digest is verified if its algorithm is SHA-1, MD5 or
SHA-256, in base 32 or hexadecimal and in letters of any case, and passed over otherwise. A
record without Content-Length has the block that follows its header; a revisit without an
HTTP header has no payload. A member that breaks off or is damaged behind its header is an
error. One that is damaged before that cannot be told from bytes that look like a magic:
``verified`` compares the records of each archive with the number its manifest states and
names the archives that lack some.

Defined results: payloads of any length are read whole. A null payload is empty; an empty
payload is a payload like any other. Among equal payloads the row with the largest page_id is the response and the rest are
revisits; rows that repeat the largest page_id are all responses. Rows without page_id
revisit the largest id, or are responses if no row of the group has one. Empty tables give
no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import short_reads, small_batches
from tallyspark.session import materialize, scratch_path

MAGIC = b"\x1f\x8b\x08"
BLOCK = 1 << 16
SPLIT_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"

MANIFEST = "path string, bytes long, records long"
RECORDS = (
    "path string, offset long, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as one gzip member."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_page_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines.append(f"WARC-Refers-To: {_page_urn(refers_to)}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, html) below ``folder``; return the written manifest."""
    spark = pages.sparkSession
    small_batches(spark)
    short_reads(spark)
    rows = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    ).withColumn("key", F.sha2("payload", 256))
    same = (
        rows.groupBy("key")
        .agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    # Only the short side is held: a sort would hold the payloads.
    marked = rows.join(same.hint("shuffle_hash"), "key", "left").select(
        "page_id",
        "url",
        "payload",
        "largest",
        F.expr("largest IS NOT NULL AND NOT (page_id <=> largest)").alias("revisit"),
    )

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        path = f"{base}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, size, count = None, 0, 0
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(path, compression=None)
                page_id, url, payload, largest, revisit = row
                member = record(page_id, url, payload, largest, revisit)
                out.write(member)
                size += len(member)
                count += 1
        if out is not None:
            out.close()
            shown = folder[: len(folder) - len(base)] + path if folder.endswith(base) else path
            yield pa.RecordBatch.from_pylist([{"path": shown, "bytes": size, "records": count}])

    # One row an archive: they go into one file, not into one for each task.
    return materialize(marked.mapInArrow(write_part, MANIFEST).repartition(1), "warc-manifest")


class _Source:
    """Bytes of one archive from a position on, read as far as asked."""

    def __init__(self, file, size: int, start: int, stop: int):
        self.file, self.size, self.start = file, size, start
        file.seek(start)
        self.data = bytearray(file.read(min(size, stop + BLOCK) - start))

    def get(self, at: int, count: int) -> bytes:
        end = min(at + count, self.size)
        if end > self.start + len(self.data):
            self.file.seek(self.start + len(self.data))
            self.data += self.file.read(max(end - self.start - len(self.data), BLOCK))
        return bytes(memoryview(self.data)[at - self.start : end - self.start])

    def find(self, at: int, stop: int) -> int:
        """Place of the next magic that starts before ``stop``, or -1."""
        self.get(at, stop + len(MAGIC) - 1 - at)
        place = self.data.find(MAGIC, at - self.start, stop + len(MAGIC) - 1 - self.start)
        return place if place < 0 else place + self.start


def _inflate(source: _Source, at: int) -> tuple[bytes, int] | None:
    """Content and end of the member at a place; None if it does not hold a WARC record."""
    unpacker, out, place, known = zlib.decompressobj(31), bytearray(), at, False
    step = 4096
    while not unpacker.eof:
        chunk = source.get(place, step)
        if not chunk:
            if known or out.startswith(b"WARC/1."):
                raise OSError(f"the record at {at} is cut off")
            return None
        try:
            out += unpacker.decompress(chunk)
        except zlib.error:
            if known:
                raise
            return None
        place += len(chunk)
        step = BLOCK
        if not known and len(out) >= 7:
            if not out.startswith(b"WARC/1."):
                return None
            known = b"\r\n\r\n" in out
    if not known and not (out.startswith(b"WARC/1.") and b"\r\n\r\n" in out):
        return None
    return bytes(out), place - len(unpacker.unused_data)


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _urn_id(value: str | None) -> str | None:
    return None if value is None else value.strip("<>")


def _agrees(stated: str, payload: bytes) -> bool:
    """Whether a stated digest, ``algorithm:value``, is that of the payload; unknown ones pass."""
    algorithm, _, value = stated.partition(":")
    name = algorithm.strip().lower().replace("-", "")
    if name not in ("sha1", "md5", "sha256"):
        return True
    digest = hashlib.new(name, payload).digest()
    forms = (digest.hex().upper(), base64.b32encode(digest).decode())
    return value.strip().rstrip("=").upper() in [form.rstrip("=") for form in forms]


def parse(content: bytes) -> dict:
    """Fields and payload of one inflated record."""
    header, _, rest = content.partition(b"\r\n\r\n")
    fields = _fields(header)
    stated_length = fields.get("content-length", "")
    block = rest[: int(stated_length)] if stated_length.isdigit() else rest.removesuffix(b"\r\n\r\n")
    kind = fields.get("warc-type")
    payload, length, http = block, len(block), b""
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        length = len(payload)
    digest = payload_digest(payload)
    stated = fields.get("warc-payload-digest") or None
    if kind == "revisit":
        digest, payload = stated and re.sub("(?i)^sha1:", "", stated), None
        of_http = _fields(http).get("content-length", "")
        length = int(of_http) if length == 0 and of_http.isdigit() else length
    elif stated is not None and not _agrees(stated, payload):
        raise ValueError(f"the payload of {fields.get('warc-record-id')} does not match its digest")
    return {
        "record_type": kind,
        "record_id": _urn_id(fields.get("warc-record-id")),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": _urn_id(fields.get("warc-refers-to")),
        "payload_digest": digest,
        "payload_bytes": length,
        "payload": payload,
    }


def records_in(file, size: int, start: int, stop: int) -> Iterable[tuple[int, dict]]:
    """The records that start in [start, stop) of an open archive."""
    source = _Source(file, size, start, stop)
    at = start
    while 0 <= (at := source.find(at, stop)) < stop:
        member = _inflate(source, at)
        if member is None:
            at += 1
            continue
        yield at, parse(member[0])
        at = member[1]
        if at >= stop:
            return


def read(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of the archives (path, bytes), read by ranges of ``split_bytes``."""
    spark = archives.sparkSession
    held = archives.agg(
        F.coalesce(F.sum(F.ceil(F.col("bytes") / split_bytes)), F.lit(0)).alias("ranges"),
        F.coalesce(F.ceil(F.sum("bytes") / split_bytes), F.lit(0)).alias("full"),
    ).first()
    # Small archives share a task, as long as every core has one.
    tasks = max(int(held.full), min(int(held.ranges), spark.sparkContext.defaultParallelism), 1)
    ranges = (
        archives.where("bytes > 0")
        .select(
            "path", "bytes", F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("start")
        )
        .repartition(tasks)
    )
    schema = pa.schema(
        [
            ("path", pa.string()),
            ("offset", pa.int64()),
            *[(c, pa.string()) for c in ("record_type", "record_id", "target_uri", "refers_to", "payload_digest")],
            ("payload_bytes", pa.int64()),
            ("payload", pa.binary()),
        ]
    )

    def read_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(row["path"])
                found, held = [], 0
                with store.open_input_file(path) as file:
                    stop = min(row["start"] + split_bytes, row["bytes"])
                    for at, content in records_in(file, row["bytes"], row["start"], stop):
                        found.append({"path": row["path"], "offset": at, **content})
                        held += content["payload_bytes"]
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(found, schema)
                            found, held = [], 0
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema)

    return ranges.mapInArrow(read_part, RECORDS)


def verified(archives: DataFrame, records: DataFrame) -> DataFrame:
    """The written records, if there are as many of each archive as (path, records) states."""
    found = records.groupBy("path").agg(F.count("*").alias("found"))
    counts = archives.groupBy("path").agg(F.max("records").alias("records"))
    lacking = (
        counts.join(found, "path", "left")
        .where("records IS NOT NULL AND coalesce(found, 0) <> records")
        .orderBy("path")
        .limit(10)
        .collect()
    )
    if lacking:
        shown = ", ".join(f"{row.path}: {row.found or 0} of {row.records}" for row in lacking)
        raise OSError(f"archives with other numbers of records than their manifest states: {shown}")
    return records


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write pages as archives and answer one row per page from what is read back."""
    archives = write(pages, scratch_path(spark, "warc"))
    back = materialize(read(archives).drop("payload", "offset"), "warc-records")

    def page(column: str):
        return F.regexp_extract(column, r"^urn:page:(-?[0-9]*)$", 1).try_cast("long")

    return verified(archives, back).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
        "target_uri",
    )
