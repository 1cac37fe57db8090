"""Quality classifier: naive Bayes features for a linear hinge-loss model.

Indicators of character n-grams and of n-grams of word shapes are scaled by the log of the
ratio in which the classes contain them; a hinge-loss model on the scaled indicators is
fitted by dual coordinate descent on a bounded sample of labelled rows (whole texts), and a
logistic curve, fitted on rows the model has not seen, turns margins into scores.

Inputs of a score: the text alone. Defined results: a null text counts as empty; an empty
text has the score of the bias. Repeated rows are each answered; rows without doc_id are
held out. Without labelled rows of both classes every score is 0.5.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import common, linear

SAMPLE_ROWS = 6_000
BUCKET_BITS = 18
CHAR_WIDTHS = (2, 4)
SMOOTHING = 1.0
COST = 0.1
PASSES = 15
CALIBRATION_SHARE = 4
THRESHOLD = 0.3

_BUCKETS = 1 << BUCKET_BITS
_SHIFT = np.uint64(64 - BUCKET_BITS)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _distinct(buckets: np.ndarray, stamps: np.ndarray) -> np.ndarray:
    """One place for each distinct value: the last writer of its stamp."""
    places = np.arange(len(buckets), dtype=np.int32)
    stamps[buckets] = places
    return buckets[stamps[buckets] == places]


def _bucket(keys: np.ndarray, salt: int) -> np.ndarray:
    return (((keys + np.uint64(salt)) * _PRIME) >> _SHIFT).astype(np.int64)


def word_shapes(points: np.ndarray) -> np.ndarray:
    """Small number for each word: case, marks, digits, length class, and repeats of the word before."""
    inside, starts = common.word_bounds(points)
    if not len(starts):
        return np.empty(0, np.uint64)
    upper = ((points >= 65) & (points <= 90)) | ((points >= 192) & (points <= 222) & (points != 215))
    lower = ((points >= 97) & (points <= 122)) | ((points >= 223) & (points != 247))
    digit = (points >= 48) & (points <= 57)
    mark = inside & ~upper & ~lower & ~digit
    counts = [np.add.reduceat(m.astype(np.int32), starts) for m in (upper, lower, digit, mark)]
    length = np.add.reduceat(inside.astype(np.int32), starts)
    words = common.word_hashes(points)
    again = np.zeros(len(words), np.uint64)
    again[1:] = words[1:] == words[:-1]
    shape = np.minimum(counts[0], 2) * 3 + (counts[1] > 0) + (counts[1] > 3)
    shape = (shape * 2 + (counts[2] > 0)) * 4 + np.minimum(counts[3], 3)
    shape = shape * 5 + np.minimum(length // 3, 4)
    return shape.astype(np.uint64) * np.uint64(2) + again


class Features:
    """Distinct feature buckets of a text; keeps one scratch array."""

    def __init__(self):
        self.stamps = np.zeros(_BUCKETS, np.int32)

    def of(self, text: str) -> np.ndarray:
        points = common.codes(text).astype(np.uint64)
        keys = []
        for width in CHAR_WIDTHS:
            count = len(points) - width + 1
            if count > 0:
                key = np.zeros(count, np.uint64)
                for j in range(width):
                    key = key * np.uint64(0x100000001B3) + points[j : j + count]
                keys.append(_bucket(key, width * 0x1F1F1F1F))
        shapes = word_shapes(points)
        for width in (1, 3):
            count = len(shapes) - width + 1
            if count > 0:
                key = np.zeros(count, np.uint64)
                for j in range(width):
                    key = key * np.uint64(0x100000001B3) + shapes[j : j + count]
                keys.append(_bucket(key, width * 0x3D3D3D3D + 5))
        if not keys:
            return np.empty(0, np.int64)
        return _distinct(np.concatenate(keys), self.stamps)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, features: np.ndarray) -> float:
        """Sum of weights over the root of the feature count, so that length does not decide."""
        return float(self.weights[features].sum()) / max(len(features), 1) ** 0.5 + self.bias

    def score(self, features: np.ndarray) -> float:
        return linear.logistic(self.slope * self.margin(features) + self.shift)


class _Scaled(Sequence):
    """The values of each row's indicators, made when asked for: only their numbers stay in memory."""

    def __init__(self, rows: list[np.ndarray], ratio: np.ndarray):
        self.rows, self.ratio = rows, ratio

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, k: int) -> np.ndarray:
        row = self.rows[k]
        return self.ratio[row] / max(len(row), 1) ** 0.5


def train(rows: Iterable[tuple[str, int]]) -> Model:
    """Fit on (text, label) in the given order; every ``CALIBRATION_SHARE``-th row calibrates.

    A text is let go once its features are known; those take 4 bytes each.
    """
    features = Features()
    found, marked = [], []
    for text, label in rows:
        found.append(features.of(text).astype(np.int32))
        marked.append(label)
    labels = np.array(marked, np.int64)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(_BUCKETS), 0.0, 1.0, 0.0)
    aside = np.arange(len(labels)) % CALIBRATION_SHARE == 0
    learn = np.flatnonzero(~aside)
    counts = np.full((2, _BUCKETS), SMOOTHING)
    for k in learn:
        counts[labels[k], found[k]] += 1
    totals = np.array([max(int((labels[learn] == c).sum()), 1) + 2 * SMOOTHING for c in (0, 1)])
    ratio = np.log(counts[1] / totals[1]) - np.log(counts[0] / totals[0])
    signs = np.where(labels[learn] == 1, 1.0, -1.0)
    share = max(float((signs > 0).mean()), 1e-3), max(float((signs < 0).mean()), 1e-3)
    costs = np.where(signs > 0, 0.5 / share[0], 0.5 / share[1]) * COST
    learnt = [found[k] for k in learn]
    weights = linear.fit_hinge(learnt, _Scaled(learnt, ratio), signs, costs, _BUCKETS, PASSES)
    model = Model((weights[:-1] * ratio), float(weights[-1]), 1.0, 0.0)
    margins = np.array([model.margin(found[k]) for k in np.flatnonzero(aside)])
    model.slope, model.shift = linear.calibrate(margins, labels[aside])
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """Fit in one task on at most ``rows`` labelled documents outside the held-out fold.

    Spark puts the rows in order; the task reads their texts batch by batch.
    """
    common.small_batches(docs.sparkSession)
    sample = common.labelled_sample(docs, labels, label, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.forget()
        read = (
            pair
            for batch in batches
            for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        )
        first = next(read, None)
        if first is not None:
            model = pickle.dumps(train(itertools.chain([first], read)))
            common.release()
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    one = sample.select("text", "label", F.xxhash64("doc_id").alias("order")).repartition(1)
    ordered = one.sortWithinPartitions("order", "text", "label").select("text", "label")
    fitted = ordered.mapInArrow(run, "model binary").collect()
    return pickle.loads(fitted[0].model) if fitted else Model(np.zeros(_BUCKETS), 0.0, 1.0, 0.0)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with held_out, score and predicted."""
    spark = docs.sparkSession
    common.small_batches(spark)
    others = [c for c in docs.columns if c not in ("score", "predicted", "held_out")]
    schema = ", ".join(f"`{c}` {dict(docs.dtypes)[c]}" for c in others) + ", score double"
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.forget()
        own, features = shared.value, Features()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            scores = pa.array([own.score(features.of(text or "")) for text in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*others, "score"])
        common.release()

    scored = docs.select(*others).mapInArrow(run, schema)
    return scored.withColumn("held_out", common.held_out(F.col("doc_id"))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
