"""Encoding and decoding against the library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tallyspark.llm import sentencepiece_codec as sc

EDGES = [
    "", " ", "  ", "\n", "\n ", "a\n b", " a", "a ", "a  b", "a▁b", "▁", "▁▁ ▁", "日本語テキスト 한국어 🙂🙂",
    "\x00a\tb\r\n", "<s></s><unk> <0x0A>", "a" * 3000, "=====----====" * 20, " " * 50 + "x" + " " * 33, "é" * 60,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sc.MODEL))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    return EDGES + [
        "".join(rng.choice(" ▁\nabtheinoéß.0123日🙂=-") for _ in range(rng.randrange(40))) for _ in range(1500)
    ]


def test_ids_and_texts(library, texts):
    codec = sc.codec()
    for text in texts:
        ids = library.encode(text, add_eos=True)
        assert codec.encode(text) == ids, text
        assert codec.decode(ids) == library.decode(ids), text


def test_the_table_agrees_with_merging(texts):
    codec = sc.codec()
    for text in texts[:400]:
        known = "".join(c for c in text if c in codec.letters)[:60]
        if known:
            assert codec._known(known) == codec.merge(known)


def test_decoding_bytes_that_are_no_text(library):
    codec = sc.codec()
    ids = [codec.byte_ids[0x61], codec.byte_ids[0x62], codec.end]
    assert codec.decode(ids) == library.decode(ids) == "ab"


def test_memory_is_bounded():
    from tallyspark.llm.common import Memo

    memo = Memo(str.upper, 3)
    assert [memo[c] for c in "abcdabcd"] == list("ABCDABCD")
    assert len(memo) <= 3 and len(memo.former) <= 3
    assert memo["x" * 100] == "X" * 100 and "x" * 100 not in memo


def test_pair_tests_are_bounded(library, monkeypatch):
    """Random text meets ever new pairs of tokens; the ids stay right while few are remembered."""
    monkeypatch.setattr(sc, "PAIRS", 50)
    own = sc.Codec(public_tokenizers.path(sc.MODEL))
    rng = random.Random(6)
    for _ in range(30):
        text = "".join(rng.choice("abcdefghij klmnop") for _ in range(300))
        assert own.encode(text) == library.encode(text) + [library.eos_id()]
        assert len(own.compatible) <= 50 and len(own.former_pairs) <= 50


def test_digests(spark, library):
    rows = list(enumerate([*EDGES, None])) + [(0, "again"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit(0))
    found = sc.digests(docs).collect()
    expected = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_eos=True)
        decoded = library.decode(ids)
        expected.append(
            (
                doc_id,
                len(ids),
                hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest(),
            )
        )
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert sc.digests(docs.where("doc_id > 1000")).collect() == []
