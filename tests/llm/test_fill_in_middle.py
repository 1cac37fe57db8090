"""Cuts against a plain version, ranks against counting, texts restored from outputs."""

import hashlib
import random
import re

import numpy as np
import pytest

from tallyspark.llm import fill_in_middle as fim

TOKENS = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)
SCHEMA = "doc_id long, text string, form string, output int, n string"


def plain(doc_id, text):
    """The contract, word for word."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = TOKENS.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted(x % (n + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def random_text(rng, length):
    return "".join(rng.choice("abcXYZ  0.é\n<\U0001f600-") for _ in range(length))


def test_ranks_of_the_wavelet_matrix():
    symbols = np.random.default_rng(1).integers(0, 8, 1000).astype(np.uint8)
    matrix = fim.WaveletMatrix(symbols)
    ends = np.arange(1001)
    for symbol in range(8):
        counted = np.concatenate([[0], np.cumsum(symbols == symbol)])
        assert (matrix.rank(symbol, ends) == counted).all()


def test_ranks_of_nothing():
    assert fim.WaveletMatrix(np.empty(0, np.uint8)).rank(3, np.array([0])).tolist() == [0]


@pytest.mark.parametrize("unit,pattern", [("token", "[A-Za-z]+|[^A-Za-z]"), ("char", "."), ("word", "[A-Za-z]+")])
def test_every_cut(unit, pattern):
    rng = random.Random(2)
    texts = ["", "ab", "ab", "9", *[random_text(rng, rng.randrange(200)) for _ in range(50)], ""]
    own = fim.Units(texts, unit)
    starts = [[m.start() for m in re.finditer(pattern, text, re.S)] for text in texts]
    assert own.counts.tolist() == [len(s) for s in starts]
    for k in range(max(map(len, starts)) + 1):
        want = [0 if k == 0 else [*s, len(t)][min(k, len(s))] for s, t in zip(starts, texts, strict=True)]
        asked = np.minimum(k, own.counts)
        got = own.cut_after(asked).tolist()
        assert got == [0 if a == 0 else w for a, w in zip(asked.tolist(), want, strict=True)]


def test_against_a_plain_version(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "a", "word", "a<P>b", "<S>", "x<M>", "<P", "<<S", "é é", "\U0001f600"]
    texts += [random_text(rng, rng.randrange(1, 120)) for _ in range(400)]
    rows = [(k, text) for k, text in enumerate(texts)] + [(5, texts[20]), (5, texts[20]), (None, texts[30])]
    docs = spark.createDataFrame([(i, t, "x", 7, "y") for i, t in rows], SCHEMA)
    out = fim.transform(docs)
    assert sorted(map(tuple, out.collect()), key=str) == sorted((plain(*row) for row in rows), key=str)
    assert {r.form for r in out.select("form").distinct().collect()} == {"plain", "psm", "spm"}
    sums = {(r.doc_id, r.n, r.output_sha256): r.restored_sha256 for r in fim.digests(out).collect()}
    for doc_id, text in rows:
        _, n, *_, output = plain(doc_id, text)
        key = (doc_id, n, hashlib.sha256(output.encode()).hexdigest())
        assert sums[key] == hashlib.sha256((text or "").encode()).hexdigest()


def test_very_long_texts(spark, monkeypatch):
    rows = [(k, text) for k, text in enumerate(["ab c" * 400_000, "z" * 1_500_000, "9 " * 300_000, "short"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in fim.transform(docs).collect()} == {plain(*row) for row in rows}


def test_chunks_keep_all_texts_in_order(monkeypatch):
    monkeypatch.setattr(fim, "CHUNK_CHARS", 10)
    texts = ["a" * n for n in (3, 20, 4, 4, 4, 0, 11, 10)]
    parts = [texts[part] for part in fim._chunks(texts)]
    assert sum(parts, []) == texts and all(len(p) == 1 or sum(map(len, p)) <= 10 for p in parts)
    assert list(fim._chunks([])) == []


def test_empty_table_and_unknown_unit(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fim.digests(fim.transform(docs)).count() == 0
    with pytest.raises(ValueError, match="unknown unit"):
        fim.transform(docs, unit="page")
