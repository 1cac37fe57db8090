"""Ids against the tokenizer, packings against their rules and the lower bound."""

import random
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyspark.llm import common, packing

EDGES = [
    "", "a", "don't it's 'S we'LL", "日本 ΣΑΣ İstanbul <|endoftext|> x", "<|ENDOFTEXT|>", "\ta b\x1cc\x85d  e\r\n",
    "x" * 9000, "ÀÉ Œuvre naïve…", "a.b,c!! d%%% e*** 12ab3", "½ ² ª º µ", "A" * 60,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def test_a_process_keeps_the_encoder_until_another_operator_runs():
    kept = weakref.ref(packing.encoder())
    assert packing.encoder() is kept()
    common.forget()
    assert kept() is None


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids(tokenizer):
    rng = random.Random(3)
    texts = EDGES + [
        "".join(rng.choice(" \nAabZz.,!'sé½²ª<|µÀÿĮ1\t- ") for _ in range(rng.randrange(40))) for _ in range(1500)
    ]
    for text, data in zip(texts, packing.encoder().encode_all(texts), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == ids_of(tokenizer, text), text


def test_crossover_keeps_every_piece_once():
    rng = random.Random(4)
    sizes = [rng.randint(1, 2047) for _ in range(300)]
    order = list(range(300))
    parents = []
    for _ in range(2):
        rng.shuffle(order)
        bins = []
        packing.best_fit(bins, order, sizes, 2048)
        parents.append(bins)
    for _ in range(20):
        child = packing.crossover(*parents, sizes, 2048, rng)
        assert sorted(i for members in child for i in members) == list(range(300))
        assert max(sum(sizes[i] for i in members) for members in child) <= 2048
        parents = [parents[1], child]


def test_evolution_never_loses_its_elite():
    rng = random.Random(5)
    sizes = [rng.choice([700, 690, 650, 1024, 340]) for _ in range(200)]
    start = packing.evolve(sizes, [], 1)
    later = packing.evolve(sizes, [start], 2)
    assert packing.fitness(later, sizes) <= packing.fitness(start, sizes)


@pytest.mark.parametrize("low,high,gain", [(500, 1001, 0.03), (300, 900, 0.01)])
def test_generations_beat_best_fit_where_there_is_room(low, high, gain):
    rng = random.Random(5)
    sizes = [rng.randrange(low, high) for _ in range(4000)]
    plain = []
    packing.best_fit(plain, sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes, 2048)
    found = packing.evolve(sizes, [], 1)
    assert sorted(i for members in found for i in members) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in members) <= 2048 for members in found)
    assert packing.floor_of(sizes, 2048) <= len(found) <= len(plain) * (1 - gain)


def test_a_floor_that_is_reached_costs_no_generations(monkeypatch):
    sizes = [1025, 1500, 1023, 500, 1999]
    assert packing.floor_of(sizes, 2048) == 3
    monkeypatch.setattr(packing, "crossover", None)
    assert len(packing.evolve(sizes, [], 1)) == 3


def check(rows, texts, tokenizer):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    expected = []
    for doc_id, text in texts:
        ids = ids_of(tokenizer, text)
        for start in range(0, len(ids), 2048):
            part = ids[start : start + 2048]
            expected.append((doc_id, start // 2048, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    return len(by_sequence), -(-sum(e[3] for e in expected) // 2048)


def test_documents(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 40)  # several blocks and rounds
    rng = random.Random(6)
    texts = [(k, "river " * rng.randint(0, 1500)) for k in range(150)]
    texts += [(k, t) for k, t in enumerate(EDGES, 1000)]
    texts += [(2000, None), (None, "no id"), (3, "again"), (2001, "stone " * 9000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("block", F.lit("own"))
    used, bound = check(packing.pack_documents(docs).collect(), texts, tokenizer)
    assert used <= bound * 1.1 + 1


def test_one_block_is_near_the_bound(spark, tokenizer):
    rng = random.Random(7)
    texts = [(k, "river " * rng.randint(1, 1900)) for k in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    used, bound = check(packing.pack_documents(docs).collect(), texts, tokenizer)
    assert used <= bound * 1.03 + 1
    assert packing.pack_documents(docs.where("doc_id > 999")).collect() == []
