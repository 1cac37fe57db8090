"""Prefix hashes against string comparison; pairs against a plain loop."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import fingerprints as fp

RNG = random.Random(3)


def text(n, letters="abé🙂 "):
    return "".join(RNG.choice(letters) for _ in range(n))


def test_span_equality_and_extensions():
    shared = text(50)
    a, b = text(30) + shared + "x" + text(20), text(7) + shared + "y" + text(9)
    pa, pb = fp.Prefixes(a), fp.Prefixes(b)
    for _ in range(3000):
        i, j = RNG.randrange(len(a)), RNG.randrange(len(b))
        n = RNG.randrange(min(len(a) - i, len(b) - j) + 1)
        assert fp.spans_equal(pa, i, pb, j, n) == (a[i : i + n] == b[j : j + n])
        assert (pa.span(i, i + n) == pb.span(j, j + n)) == (a[i : i + n] == b[j : j + n])
        assert fp.longest_common_extension(pa, i, pb, j) == len(os.path.commonprefix([a[i:], b[j:]]))
    assert fp.longest_common_extension(pa, 30, pb, 7) == 50


def test_likeness():
    words = [text(8, "abcdefghij") for _ in range(300)]
    whole = " ".join(words)
    mark = fp.fingerprint(fp.Prefixes(whole))
    near = fp.fingerprint(fp.Prefixes(" ".join(words[:270])))
    far = fp.fingerprint(fp.Prefixes(" ".join(text(8, "abcdefghij") for _ in range(300))))
    assert fp.likeness(mark, mark) == 1.0
    assert fp.likeness(mark, near) > 0.7 and fp.likeness(mark, far) < 0.1
    empty = fp.fingerprint(fp.Prefixes(""))
    assert fp.likeness(empty, empty) == 1.0 and fp.likeness(empty, mark) == 0.0
    assert fp.fingerprint(fp.Prefixes("ab")) != fp.fingerprint(fp.Prefixes("ba"))


ROWS = [(k, text(RNG.randrange(200))) for k in range(40)]
ROWS += [(100, None), (101, ""), (102, "a"), (103, "abcd" * 5000), (104, "x" * 9), (None, "without id"), (50, "twice"), (50, "twice")]


@pytest.mark.parametrize("parts", [1, 4])
def test_against_next(spark, parts):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("part", F.lit(0)).repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = fp.against_next(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    rows = sorted(((i, t or "") for i, t in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = []
    for (doc_id, own), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        tail = len(own) // 4
        edited = own[: len(own) - tail] + following[:tail]
        expected.append((doc_id, len(own), hashlib.sha256(edited.encode()).hexdigest(), own == edited))
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited == 1.0 and r.fingerprint == r.edited_fingerprint) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    same = [r for r in found if r.doc_id == 50]
    assert same[0].fingerprint == same[1].fingerprint and max(r.near_next for r in same) == 1.0


def test_texts_are_read_in_short_vectors(spark, tmp_path):
    path, key = str(tmp_path / "docs.parquet"), "spark.sql.parquet.columnarReaderBatchSize"
    spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("abcdefgh").alias("text")).coalesce(1).write.parquet(path)
    spark.conf.unset(key)
    assert fp.against_next(spark.read.parquet(path)).count() == 3000
    assert int(spark.conf.get(key)) <= 500


def test_empty_and_single(spark):
    docs = spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")
    assert fp.against_next(docs.where("doc_id > 1")).collect() == []
    row = fp.against_next(docs).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1.0
