"""Archives: exact round trips, any split size, foreign bytes between records."""

import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import warc
from tallyspark.session import materialize, scratch_path

ROWS = [
    (1, "http://a.example/x", "<p>one</p>"),
    (5, "http://b.example/é y", "<p>one</p>"),
    (3, None, None),
    (4, "http://c.example/\r\nWARC-Type: resource", ""),
    (7, "u", "x" * 300_000),
    (8, "u", "日本\r\n\r\nWARC/1.1\r\n"),
    (9, "u", "twice"),
    (9, "v", "twice"),
    (None, "n", "only without id"),
    (None, "n", "twice"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string")


def expected():
    largest = {}
    for page_id, _, html in ROWS:
        if page_id is not None:
            largest[html or ""] = max(largest.get(html or "", page_id), page_id)
    for page_id, _, html in ROWS:
        body = (html or "").encode()
        top = largest.get(html or "")
        revisit = top is not None and page_id != top
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        yield (page_id, len(body), digest, "revisit" if revisit else "response", top if revisit else None)


def order(rows):
    return sorted(rows, key=repr)


def test_round_trip(spark, pages):
    rows = warc.round_trip(spark, pages.withColumn("payload", F.lit(1))).drop("target_uri").collect()
    assert order(map(tuple, rows)) == order(expected())


@pytest.mark.parametrize("split", [61, 1000, 1 << 20])
def test_every_split_size_finds_each_record_once(spark, pages, split):
    archives = warc.write(pages, scratch_path(spark, "warc"))
    rows = warc.read(archives, split).collect()
    assert len(rows) == len(ROWS) == archives.agg(F.sum("records")).first()[0]
    bodies = sorted(bytes(r.payload) for r in rows if r.record_type == "response")
    kept = [(html or "").encode() for (_, _, html), e in zip(ROWS, expected(), strict=True) if e[3] == "response"]
    assert bodies == sorted(kept)


def test_small_archives_share_files_and_tasks(spark):
    cores, parts = spark.sparkContext.defaultParallelism, 24
    pages = spark.range(200).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), (F.col("id") % 150).cast("string").alias("html")
    )
    changed = {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        archives = warc.write(pages, scratch_path(spark, "warc"))
        assert archives.count() > cores and len(archives.inputFiles()) == 1
        back = materialize(warc.read(archives), "few")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(back.inputFiles()) <= cores
    assert back.count() == 200 and back.where("record_type = 'revisit'").count() == 50


def test_payloads_are_not_sorted(spark, pages, monkeypatch):
    plans = []

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, label)

    monkeypatch.setattr(warc, "materialize", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        warc.write(pages, scratch_path(spark, "warc"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ShuffledHashJoin" in plans[0] and "Sort" not in plans[0]


def test_archives_are_plain_gzip(spark, pages):
    archives = warc.write(pages, scratch_path(spark, "warc"))
    text = b"".join(gzip.open(r.path.removeprefix("file:")).read() for r in archives.collect())
    assert text.count(b"WARC-Record-ID: ") == len(ROWS)


def test_false_magic_is_passed_over():
    first = warc.record(1, "u", b"a", None, False)
    second = warc.record(2, "u", b"b", None, False)
    data = b"\x1f\x8b\x08junk" + first + warc.MAGIC + gzip.compress(b"no archive") + second
    for step in (7, 50, 10_000):
        found = [
            content["record_id"]
            for start in range(0, len(data), step)
            for _, content in warc.records_in(io.BytesIO(data), len(data), start, min(start + step, len(data)))
        ]
        assert found == ["urn:page:1", "urn:page:2"]


def test_a_cut_record_is_an_error():
    data = warc.record(1, "u", bytes(range(256)) * 3000, None, False)[:-20]
    with pytest.raises(OSError):
        list(warc.records_in(io.BytesIO(data), len(data), 0, len(data)))


def member(fields, block=b"body"):
    head = "\r\n".join(["WARC/1.0", *[f"{k}: {v}" for k, v in fields.items()]]).encode()
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize(
    "digest",
    [
        "md5:841a2d689ad86bd1611447453c22c6fc",
        "MD5:841A2D689AD86BD1611447453C22C6FC",
        "SHA1:" + base64.b32encode(hashlib.sha1(b"body").digest()).decode().lower(),
        "sha-256:" + hashlib.sha256(b"body").hexdigest(),
        "whirl:nothing we know",
    ],
)
def test_digests_of_foreign_archives(digest):
    fields = {"WARC-Type": "response", "Content-Length": 4, "WARC-Payload-Digest": digest}
    found = warc.parse(member(fields))
    assert (found["payload"], found["payload_bytes"]) == (b"body", 4)
    if not digest.startswith("whirl"):
        with pytest.raises(ValueError, match="does not match"):
            warc.parse(member(fields | {"Content-Length": 3}))


def test_absent_fields_of_foreign_archives():
    assert warc.parse(member({"WARC-Type": "resource"}))["payload"] == b"body"
    assert warc.parse(member({}, b""))["record_type"] is None
    revisit = warc.parse(member({"WARC-Type": "revisit", "Content-Length": 0, "WARC-Payload-Digest": "Sha1:ABC"}, b""))
    assert (revisit["payload"], revisit["payload_bytes"], revisit["payload_digest"]) == (None, 0, "ABC")


def test_a_record_cut_within_its_header_is_an_error():
    data = gzip.compress(member({"X-Long": "y" * 100_000}))
    for cut in (len(data) // 2, len(data) - 40):
        with pytest.raises(OSError, match="cut off"):
            list(warc.records_in(io.BytesIO(data[:cut]), cut, 0, cut))


def test_a_damaged_record_is_missed_in_the_count(spark, pages):
    archives = warc.write(pages, scratch_path(spark, "warc"))
    path = archives.orderBy("path").first().path.removeprefix("file:")
    data = bytearray(open(path, "rb").read())
    data[12:20] = b"\xff" * 8
    with open(path, "wb") as file:
        file.write(data)
    with pytest.raises(OSError, match="than their manifest states"):
        warc.verified(archives, materialize(warc.read(archives), "damaged"))


def test_empty_table(spark, pages):
    assert warc.round_trip(spark, pages.where("page_id > 100")).collect() == []
