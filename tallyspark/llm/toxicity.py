"""Toxicity: restore disguised words through a noisy channel, then score the restored text.

The channel writes letters as digits or marks, puts marks or spaces between them, or
repeats them. A suspicious word becomes a lattice of the letters each character may stand
for; Viterbi finds its likeliest reading under a character trigram model counted over all
texts. Words that mark toxic documents are learned from a bounded sample of labelled
rows (whole texts, restored first); the strongest words of a text give its score.

Inputs of a score: the text alone. Defined results: a null text counts as empty; a text
without telling words has the score of the logistic curve at zero. Repeated rows are each
answered; rows without doc_id are held out. Without labelled rows of both classes every
score is 0.
"""

from __future__ import annotations

import math
import os
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import common, linear

SAMPLE_ROWS = 8_000
CALIBRATION_SHARE = 4
THRESHOLD = 0.5
# A word tells if its log likelihood ratio statistic and its log odds reach these.
LEAST_EVIDENCE = 25.0
LEAST_ODDS = 1.5
# Shares with which the strongest words of a text add up.
SHARES = (1.0, 0.25, 0.1)
CACHE = 300_000
# Characters after which what all readings of a lattice begin with is settled.
SETTLE = 2_000

# What a character may stand for.
READINGS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou", "#": "h",
}
READING_COST = 0.6
MARK_COST = 0.4
SKIPPED_READING_COST = 2.5
SPACE_COST = 0.3
KEPT_SPACE_COST = 1.5
KEPT_MARK_COST = 1.5
DOUBLE_COST = 4.0
RUN_COST = 0.5

EDGE = 0
SYMBOLS = 64
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(223, 256) if c != 247)
_NUMBER = {c: k + 1 for k, c in enumerate(_LETTERS)}
_TABLE = np.zeros(256, np.int64)
for _c, _k in _NUMBER.items():
    _TABLE[ord(_c)] = _k
    if len(_c.upper()) == 1 and ord(_c.upper()) < 256:
        _TABLE[ord(_c.upper())] = _k
_PUNCTUATION = ".,;:!?\"'()[]{}<>|%&*#$-_~`/\\…«»„“”"
_RUN = re.compile(rb"\x01{2,}")
_TRIPLE = re.compile(r"(.)\1\1")
_MARKS = re.compile(r"[\W_]+")
_STRETCHED = re.compile(r"(.)\1{3,}", re.DOTALL)


# --- character model ---------------------------------------------------------------


def trigram_cells(text: str) -> np.ndarray:
    """Cell of each letter trigram; whatever is no letter is a word edge, edges count once."""
    points = common.codes(text)
    letters = _TABLE[np.where(points < 256, points, 0)]
    letters = np.concatenate([[EDGE], letters, [EDGE]])
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] != EDGE) | (letters[:-1] != EDGE)
    letters = letters[keep]
    return (letters[:-2] * SYMBOLS + letters[1:-1]) * SYMBOLS + letters[2:]


def count_trigrams(docs: DataFrame) -> np.ndarray:
    """Letter trigram counts over all texts; the driver receives at most 64**3 cells."""
    common.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(trigram_cells(text), minlength=SYMBOLS**3)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["cell", "n"])

    rows = (
        docs.where("text IS NOT NULL")
        .select("text")
        .mapInArrow(run, "cell long, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros(SYMBOLS**3)
    for row in rows:
        counts[row.cell] = row.n
    return counts


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b) for each cell, each order smoothed towards the shorter one."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (two + 10 * p1) / (two.sum(axis=1, keepdims=True) + 10)
    p3 = (three + 10 * p2[None, :, :]) / (three.sum(axis=2, keepdims=True) + 10)
    return np.log(p3).astype(np.float32)


# --- restoring ----------------------------------------------------------------------


def choices(word: str, at: int) -> list[tuple[int | None, float]]:
    """What the channel may have written a character for: (symbol or nothing, cost)."""
    char = word[at]
    found: list[tuple[int | None, float]] = []
    if char in _NUMBER:
        found.append((_NUMBER[char], 0.0))
        if at and word[at - 1] == char:
            run = at >= 2 and word[at - 2] == char or at + 1 < len(word) and word[at + 1] == char
            found.append((None, RUN_COST if run else DOUBLE_COST))
    elif char == " ":
        found += [(None, SPACE_COST), (EDGE, KEPT_SPACE_COST)]
    else:
        found += [(_NUMBER[c], READING_COST) for c in READINGS.get(char, "")]
        if not char.isdigit() or not found:
            found.append((None, SKIPPED_READING_COST if found else MARK_COST))
        if at and word[at - 1] == char and found[-1][0] is not None:
            found.append((None, RUN_COST))
        if not char.isalnum():
            found.append((EDGE, KEPT_MARK_COST))
    return found


def symbols(path: tuple) -> list[int]:
    out = []
    while path:
        symbol, path = path
        out.append(symbol)
    return out[::-1]


def settle(states: dict, settled: list[int]) -> dict:
    """Move what all paths begin with to ``settled``, so that paths stay short."""
    paths = [symbols(path) for _, path in states.values()]
    common = os.path.commonprefix(paths)
    settled += common
    kept = {}
    for (key, (cost, _)), path in zip(states.items(), paths, strict=True):
        rest: tuple = ()
        for symbol in path[len(common) :]:
            rest = (symbol, rest)
        kept[key] = (cost, rest)
    return kept


def restore(word: str, logs: np.ndarray) -> str:
    """The likeliest reading of a lower-case word, by Viterbi over its lattice.

    Words may have any length; runs of a character count as three.
    """
    word = _STRETCHED.sub(r"\1\1\1", word)
    states: dict[tuple[int, int], tuple[float, tuple]] = {(EDGE, EDGE): (0.0, ())}
    settled: list[int] = []
    for at in range(len(word)):
        if at % SETTLE == SETTLE - 1:
            states = settle(states, settled)
        following: dict[tuple[int, int], tuple[float, tuple]] = {}
        options = choices(word, at)
        for (a, b), (cost, path) in states.items():
            for symbol, price in options:
                if symbol is None:
                    key, total, way = (a, b), cost + price, path
                else:
                    key = (b, symbol)
                    total = cost + price - float(logs[a, b, symbol])
                    way = (symbol, path)
                if key not in following or total < following[key][0]:
                    following[key] = (total, way)
        states = following
    best = min(
        ((cost - float(logs[a, b, EDGE]), path) for (a, b), (cost, path) in states.items()), key=lambda x: x[0]
    )[1]
    return "".join(" " if symbol == EDGE else _LETTERS[symbol - 1] for symbol in settled + symbols(best))


class Reader:
    """Restored words of texts."""

    def __init__(self, logs: np.ndarray):
        self.logs = logs
        self.known = common.Memo(self._words, CACHE)

    def _words(self, token: str) -> tuple[str, ...]:
        """The words a token stands for: itself if plain, else its restored reading."""
        plain = token.strip(_PUNCTUATION)
        if plain.isalpha() and not _TRIPLE.search(plain):
            return (plain,)
        if not any(c in _NUMBER for c in token):
            return (plain,) if plain else ()
        # Marks at the ends may be letters in disguise or plain punctuation: read both.
        readings = {restore(t, self.logs) for t in {plain, token.strip(".,;:?\"'")} if t}
        words = {w for r in readings for w in r.split()} | {plain}
        # Marks may part words, too; single letters between marks spell one, which was read above.
        parts = _MARKS.split(plain)
        if len(parts) > 1:
            for part in {x for x in parts if len(x) > 1}:
                words.update(self._words(part))
        return tuple(sorted(words))

    def spaced(self, tokens: list[str]) -> list[str]:
        """Readings of three or more single characters in a row."""
        sizes = bytes([min(len(t), 255) for t in tokens])
        found = []
        for run in _RUN.finditer(sizes):
            start, end = run.span()
            if end < len(tokens) and len(tokens[end].strip(_PUNCTUATION)) == 1:
                end += 1
            part = tokens[start:end]
            if len(part) >= 3 and len(set(part)) > 1:
                found += restore(" ".join(part), self.logs).split()
        return found

    def words(self, text: str) -> set[str]:
        tokens = text.lower().split()
        out = set()
        for token in set(tokens):
            out.update(self.known[token])
        out.update(self.spaced(tokens))
        return out


# --- telling words ------------------------------------------------------------------


def features(word: str) -> tuple[str, ...]:
    """A word and its beginnings, so that endings not seen in training still count."""
    return (word, *[f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n])


@dataclass
class Model:
    logs: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    slope: float = 1.0
    shift: float = -60.0

    def weight(self, word: str) -> float:
        get = self.weights.get
        return max([get(name, 0.0) for name in features(word)])

    def margin(self, strengths: list[float]) -> float:
        strongest = sorted(strengths, reverse=True)[: len(SHARES)]
        return sum(share * weight for share, weight in zip(SHARES, strongest, strict=False))

    def score(self, margin: float) -> float:
        return linear.logistic(self.slope * margin + self.shift)


def telling(toxic: Counter, clean: Counter, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Log odds of the features that mark toxic documents beyond doubt."""
    out = {}
    for name, k1 in toxic.items():
        k0 = clean.get(name, 0)
        odds = math.log((k1 + 0.5) / (n_toxic + 1)) - math.log((k0 + 0.5) / (n_clean + 1))
        if odds < LEAST_ODDS:
            continue
        p = (k1 + k0) / (n_toxic + n_clean)
        evidence = 0.0
        for k, n in ((k1, n_toxic), (k0, n_clean)):
            for seen, expected in ((k, n * p), (n - k, n * (1 - p))):
                if seen:
                    evidence += 2 * seen * math.log(seen / expected)
        if evidence >= LEAST_EVIDENCE:
            out[name] = odds
    return out


def train(texts: list[str], labels: list[int], logs: np.ndarray) -> Model:
    """Fit on texts in the given order; every ``CALIBRATION_SHARE``-th row calibrates."""
    model = Model(logs)
    if len(set(labels)) < 2:
        return model
    reader = Reader(logs)
    learn = [k for k in range(len(texts)) if k % CALIBRATION_SHARE]
    toxic, clean = Counter(), Counter()
    for k in learn:
        if labels[k]:
            toxic.update({name for word in reader.words(texts[k]) for name in features(word)})
    for k in learn:
        if not labels[k]:
            found = {name for word in reader.words(texts[k]) for name in features(word)}
            clean.update(name for name in found if name in toxic)
    n_toxic = sum(labels[k] for k in learn)
    model.weights = telling(toxic, clean, n_toxic, len(learn) - n_toxic)
    aside = range(0, len(texts), CALIBRATION_SHARE)
    margins = np.array([model.margin([model.weight(w) for w in reader.words(texts[k])]) for k in aside])
    model.slope, model.shift = linear.calibrate(margins, np.array([labels[k] for k in aside]))
    return model


class Scorer:
    """Scores of texts, remembering the weight of each token."""

    def __init__(self, model: Model):
        self.model = model
        self.reader = Reader(model.logs)
        self.tokens = common.Memo(self._token, CACHE)

    def _token(self, token: str) -> float:
        return max([self.model.weight(w) for w in self.reader._words(token)], default=0.0)

    def score(self, text: str) -> float:
        tokens = text.lower().split()
        strengths = list(filter(None, map(self.tokens.__getitem__, set(tokens))))
        strengths += [self.model.weight(w) for w in set(self.reader.spaced(tokens))]
        return self.model.score(self.model.margin(strengths))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """Character model over all texts; telling words in one task on at most ``rows`` labelled rows."""
    spark = docs.sparkSession
    logs = log_model(count_trigrams(docs))
    shared = spark.sparkContext.broadcast(logs)
    sample = common.labelled_sample(docs, labels, label, rows)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("text", "ascending")])
        model = train(table.column("text").to_pylist(), table.column("label").to_pylist(), shared.value)
        fitted = (model.weights, model.slope, model.shift)
        return pa.table({"model": pa.array([pickle.dumps(fitted)], pa.binary())})

    ordered = sample.select("text", "label", F.xxhash64("doc_id").alias("order"), F.lit(0).alias("one"))
    fitted = ordered.groupBy("one").applyInArrow(run, "model binary").collect()
    return Model(logs, *pickle.loads(fitted[0].model)) if fitted else Model(logs)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    spark = docs.sparkSession
    common.small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(shared.value)
        for batch in batches:
            scores = [own.score(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        common.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
