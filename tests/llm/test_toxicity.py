"""Restored words, held-out accuracy on disguised words, defined results."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import toxicity as tx

CLEAN = ["river", "stone", "window", "garden", "letter", "winter", "paper", "silver", "market", "bridge"]
BAD = ["grobnik", "plastun", "vermolt"]


def disguise(word, rng):
    kind = rng.randrange(4)
    if kind == 0:
        return word.translate(str.maketrans("oaeis", "04315"))
    if kind == 1:
        return " ".join(word)
    if kind == 2:
        return word[:2] + word[2] * 4 + word[3:]
    return word


def texts(count, seed, hidden):
    rng = random.Random(seed)
    rows = []
    for k in range(count):
        words = rng.choices(CLEAN, k=rng.randint(15, 60))
        toxic = k % 4 == 0
        for word in rng.sample(BAD, 2) if toxic else ():
            words.insert(rng.randrange(len(words)), disguise(word, rng) if hidden else word)
        rows.append((k, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = texts(400, 1, hidden=False)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int")
    return tx.fit(docs, labels)


def test_restoring(model):
    cases = {
        "gr0bn1k": "grobnik", "plaaaastun": "plastun", "v.e.r.m.o.l.t": "vermolt", "w1nd0w": "window",
        "g r o b n i k": "grobnik", "g@rden": "garden", "letter": "letter",
    }
    for word, meant in cases.items():
        assert tx.restore(word, model.logs) == meant


def test_viterbi_finds_the_best_path(model):
    """Against all readings of short words."""
    import itertools

    for word in ("g0t", "1a1", "ss5", "w.1n"):
        best = None
        for path in itertools.product(*[tx.choices(word, k) for k in range(len(word))]):
            cost, a, b = 0.0, tx.EDGE, tx.EDGE
            for symbol, price in path:
                cost += price
                if symbol is not None:
                    cost -= float(model.logs[a, b, symbol])
                    a, b = b, symbol
            cost -= float(model.logs[a, b, tx.EDGE])
            reading = "".join(tx._LETTERS[s - 1] for s, _ in path if s)
            best = min(best, (cost, reading)) if best else (cost, reading)
        assert tx.restore(word, model.logs) == best[1]


def test_held_out_accuracy(spark, model):
    rows = texts(300, 2, hidden=True)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = {r.doc_id: r for r in tx.score(docs, model).collect()}
    right = sum(found[k].predicted == toxic for k, _, toxic in rows)
    assert right >= 0.97 * len(rows)
    assert all(found[k].predicted == 0 for k, _, toxic in rows if not toxic)


def test_defined_results(spark, model):
    rows = [(1, None), (2, ""), (3, "a a a a a a"), (4, "x" * 50_000), (None, "grobnik plastun"), (5, "river"), (5, "river")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("own"))
    found = tx.score(docs, model).collect()
    assert len(found) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert [r.predicted for r in found if r.doc_id is None] == [1]
    assert tx.score(docs.where("doc_id > 9"), model).collect() == []


def test_counts_cover_all_texts(spark):
    docs = spark.createDataFrame([("ab 1 AB",), (None,), ("é",)], "text string").repartition(3)
    counts = tx.count_trigrams(docs)
    a, b, e = (tx._NUMBER[c] for c in "abé")
    assert counts[(0 * 64 + a) * 64 + b] == 2 and counts[(a * 64 + b) * 64] == 2
    assert counts[(0 * 64 + e) * 64] == 1 and counts.sum() == 6


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "river")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert tx.score(docs, tx.fit(docs, labels)).first().predicted == 0
    assert np.isfinite(tx.fit(docs.where("doc_id > 1"), labels).logs).all()


def test_words_of_any_length(model, monkeypatch):
    reader = tx.Reader(model.logs)
    assert "grobnik" in reader.words("gro" + "o" * 60 + "bnik")
    spelled = " ".join("grobnik" + "window" * 5 + "vermolt")
    assert {"grobnik", "window", "vermolt"} <= reader.words(spelled)
    dotted = ".".join("garden" * 5 + "w1ndow")
    whole = tx.restore(dotted, model.logs)
    assert whole.replace(" ", "") == "garden" * 5 + "window" and set(whole.split()) <= reader.words(dotted)
    monkeypatch.setattr(tx, "SETTLE", 3)
    assert tx.restore(dotted, model.logs) == whole


def test_marks_without_spaces_part_words(model):
    reader = tx.Reader(model.logs)
    for token in ("river/grobnik", "stone,gr0bnik", "paper-grobnik", "river.stone(grobnik)silver", "silver_grobnik"):
        assert "grobnik" in reader.words(token), token
    assert {"vermolt", "grobnik"} <= reader.words("v.e.r.m.o.l.t-g.r.0.b.n.i.k")
    clean = tx.Scorer(model).score("river,stone/window-garden")
    assert clean < 0.5 < tx.Scorer(model).score("river,grobnik/plastun-garden,gr0bnik")
