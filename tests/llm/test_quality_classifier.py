"""Held-out accuracy, the dual solver against a plain one, defined results."""

import random
import string
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import common, linear, quality

WORDS = ["river", "stone", "window", "garden", "Letter", "winter,", "paper", "silver.", "market", "bridge"]


def corpus(count, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(count):
        words = rng.choices(WORDS, k=rng.randint(20, 80))
        bad = k % 5 == 0
        if bad:
            kind = rng.randrange(3)
            if kind == 0:
                words = [w.upper() + "!!" for w in words]
            elif kind == 1:
                words = [w for w in words[:6] for _ in range(12)]
            else:
                words = [w + rng.choice(["%%%", "$$$"]) for w in words]
        rows.append((k, " ".join(words), int(not bad)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")


def test_held_out_accuracy(spark):
    rows = corpus(600, 1)
    docs, labels = frames(spark, rows)
    found = {r.doc_id: r for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    aside = [r for r in rows if found[r[0]].held_out]
    assert 60 < len(aside) < 180
    assert sum(found[k].predicted == label for k, _, label in aside) >= 0.97 * len(aside)


def test_held_out_labels_do_not_matter(spark):
    rows = corpus(200, 2)
    docs, labels = frames(spark, rows)
    turned = labels.withColumn(
        "quality", F.when(common.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    one, two = quality.fit(docs, labels), quality.fit(docs, turned)
    assert np.array_equal(one.weights, two.weights) and (one.slope, one.shift) == (two.slope, two.shift)


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    dense = rng.standard_normal((60, 5))
    signs = np.sign(dense @ rng.standard_normal(5) + 0.3 * rng.standard_normal(60))
    costs = np.full(60, 0.5)
    rows = [np.arange(5)] * 60
    weights = linear.fit_hinge(rows, list(dense), signs, costs, 5, 2000)
    design = np.hstack([dense, np.ones((60, 1))])

    def loss(w):
        return 0.5 * w @ w + 0.5 * np.maximum(0, 1 - signs * (design @ w)).sum()

    best = loss(weights)
    for _ in range(300):
        assert loss(weights + 0.01 * rng.standard_normal(6)) >= best - 1e-3


def test_calibration_is_finite_on_separated_rows():
    slope, shift = linear.calibrate(np.array([0.0] * 90 + [9.0] * 10), np.array([0] * 90 + [1] * 10))
    assert 0 < slope < 100 and linear.logistic(shift) < 0.1 < 0.9 < linear.logistic(9 * slope + shift)


def test_indicators_are_distinct_and_repeats_are_seen():
    features = quality.Features()
    found = features.of("aaaa bbbb aaaa bbbb")
    assert len(set(found.tolist())) == len(found)
    shapes = quality.word_shapes(common.codes("one one two ONE x9 a%"))
    assert [int(s) & 1 for s in shapes] == [0, 1, 0, 0, 0, 0]
    assert len(set(shapes.tolist())) >= 5


def test_training_keeps_neither_texts_nor_values():
    rng = random.Random(4)
    texts = ["".join(rng.choices(string.ascii_letters, k=20_000)) for _ in range(200)]
    features = quality.Features()
    indicators = sum(len(features.of(text)) for text in texts)
    tracemalloc.start()
    model = quality.train((text, k % 2) for k, text in enumerate(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.weights.any() and indicators > 3_000_000
    assert peak < 8 * indicators + 20_000_000


def test_rows_are_learnt_in_one_order(spark):
    rows = corpus(300, 5)
    rows += [(k, text + " again", label) for k, text, label in rows[:100]]
    docs, _ = frames(spark, rows)
    _, labels = frames(spark, rows[:300] + [(k, text, 1 - label) for k, text, label in rows[:20]])
    one, two = quality.fit(docs, labels), quality.fit(docs.repartition(7), labels.repartition(3))
    assert np.array_equal(one.weights, two.weights) and (one.slope, one.shift) == (two.slope, two.shift)


def test_defined_results(spark):
    docs, labels = frames(spark, corpus(100, 3))
    model = quality.fit(docs, labels)
    rows = [(1, None, "x"), (2, "", "y"), (None, "river", "z"), (3, "x" * 60_000, None), (4, "a", "a"), (4, "a", "a")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = quality.score(odd, model).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [True]
    assert quality.score(odd.where("doc_id > 9"), model).collect() == []
    untrained = quality.fit(docs, labels.where("quality > 5"))
    assert {r.score for r in quality.score(docs, untrained).collect()} == {0.5}
