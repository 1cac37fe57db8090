"""Spelling variants: words one edit apart, found over a reduced alphabet.

Letters are hashed to ``SYMBOLS`` symbols. Words one edit apart have reduced words that are
equal or one edit apart, so the whole one-edit neighbourhood of every reduced word
(deletions, replacements and insertions over the few symbols) is generated and joined with
the reduced words that occur. Pairs of words behind a hit are verified on the words
themselves. The join sees distinct reduced words only, and a reduced word or neighbour is a
64-bit polynomial hash, whose edits are computed from prefix sums; a chance collision is
undone by the verification.

A word's form is its most frequent near word, if that is ``DOMINANCE`` times as frequent;
forms are followed to their end by pointer jumping. Each step multiplies the count, so the
chains are short and have no cycles.

Defined results: null and empty texts have no words; a null id counts as an empty one. Texts
and runs of any length are taken whole. Occurrences in repeated rows count each. A tie
between near words goes to the smallest in code-point order. Without words the result is
empty. Columns other than doc_id and text are not read, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import codes, mix, release, small
from tallyspark.session import materialize

MIN_CHARS = 7
MIN_COUNT = 2
DOMINANCE = 10
SYMBOLS = 6

# The letters of words, and how often a run is misspelt.
LETTERS = r"A-Za-zÀ-ÿ"
NOISE = 31

# Neighbourhoods are generated over at most this many symbols at a time.
_PART_SYMBOLS = 50_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_B = np.uint64(_BASE)


# --- words --------------------------------------------------------------------------


def runs(docs: DataFrame, least: int = 1) -> DataFrame:
    """(doc_id, run) of every maximal run of letters of at least ``least``, A-Z lower-cased."""
    found = F.regexp_extract_all(F.col("text"), F.lit(f"[{LETTERS}]{{{least},}}+"), F.lit(0))
    lower = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return docs.select("doc_id", F.explode(found).alias("run")).select("doc_id", lower.alias("run"))


def misspelt(doc_id: Column, run: Column, noise: int = NOISE) -> Column:
    """The run, without one character where ``noise`` divides the hash of id and run."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    h = F.crc32(name.cast("binary"))
    place = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), place), F.substr(run, place + 2))
    return F.when(h % noise == 0, cut).otherwise(run)


def noisy_words(docs: DataFrame) -> DataFrame:
    """(word) of every run that may have enough characters, misspelt by the rule."""
    return runs(docs, MIN_CHARS).select(misspelt(F.col("doc_id"), F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the distinct words that are long and frequent enough."""
    return (
        words.where(F.length("word") >= min_chars)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_count)
    )


# --- the reduced alphabet -----------------------------------------------------------


def symbols_of(points: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """The symbol of each code point, from 1 on."""
    return mix(points.astype(np.uint64) * _B) % np.uint64(symbols) + np.uint64(1)


def _sums(reduced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of symbol * base**place for words of one length, one a row, and the powers."""
    length = reduced.shape[1]
    powers = np.full(length + 1, _B, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.zeros((len(reduced), length + 1), np.uint64)
    np.cumsum(reduced * powers[:length], axis=1, out=sums[:, 1:])
    return sums, powers


def neighbourhood(reduced: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """Hashes of a reduced word and of all words one edit away, a row per word, repeats included."""
    sums, powers = _sums(reduced)
    length = reduced.shape[1]
    whole, before = sums[:, -1:], sums[:, :-1]
    parts = [whole, before + (whole - sums[:, 1:]) * _INVERSE]
    for symbol in np.arange(1, symbols + 1, dtype=np.uint64):
        parts.append(whole + (symbol - reduced) * powers[:length])
        parts.append(sums + symbol * powers + (whole - sums) * _B)
    return np.concatenate(parts, axis=1)


def _by_length(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, reduced words) of the words of each length, in parts of bounded size."""
    lengths = np.array([len(word) for word in words], np.int64)
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        step = max(1, _PART_SYMBOLS // int(max(length, 1)) ** 2)
        for at in range(0, len(places), step):
            part = places[at : at + step]
            points = codes("".join([words[k] for k in part]))
            yield part, symbols_of(points, symbols).reshape(len(part), int(length))


def with_key(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """Add the hash of each word's reduced word as ``key``; expects the columns word and n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            keys = np.zeros(len(texts), np.uint64)
            for places, reduced in _by_length(texts, symbols):
                keys[places] = mix(_sums(reduced)[0][:, -1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys.view(np.int64))], ["word", "n", "key"]
            )

    return words.select("word", "n").mapInArrow(run, "word string, n long, key long")


def neighbour_keys(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(key, near_key) for the reduced word behind each word and all of its one-edit neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, reduced in _by_length(batch.column(0).to_pylist(), symbols):
                near = mix(neighbourhood(reduced, symbols))
                own = np.broadcast_to(near[:, :1], near.shape).view(np.int64)
                near = np.sort(near.view(np.int64), axis=1)
                # Each unordered pair of reduced words is reached from both; one will do.
                keep = near >= own
                keep[:, 1:] &= near[:, 1:] != near[:, :-1]
                yield pa.RecordBatch.from_arrays([pa.array(own[keep]), pa.array(near[keep])], ["key", "near_key"])
        release()

    return words.select("word").mapInArrow(run, "key long, near_key long")


# --- pairs, forms, roots ------------------------------------------------------------


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, near, near_n) for every two words one edit apart, both ways round."""
    keyed = materialize(with_key(words, symbols), "reduced-words")
    reduced = materialize(keyed.groupBy("key").agg(F.min("word").alias("word")), "reduced")
    present = small(reduced.select(F.col("key").alias("near_key")))
    hits = materialize(neighbour_keys(reduced, symbols).join(present, "near_key"), "reduced-pairs")
    left = keyed.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = keyed.select(F.col("key").alias("near_key"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    one_edit = F.levenshtein("a", "b", 1) == 1
    ordered = (F.col("key") != F.col("near_key")) | (F.col("a") < F.col("b"))
    pairs = hits.join(left, "key").join(right, "near_key").where(ordered & one_edit)
    ways = F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    return pairs.select(F.inline(ways))


def forms_of(near: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """(word, n_near, form, form_n) of the words with near ones; form and form_n may be null."""
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near")))
    found = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.first("n").alias("n"), best.alias("best"))
    rules = F.col("best.near_n") >= dominance * F.col("n")
    return found.select(
        "word", "n_near", F.when(rules, F.col("best.near")).alias("form"), F.when(rules, F.col("best.near_n")).alias("form_n")
    )


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the end of its chain of forms.

    Every round looks up the root of the root, which doubles the steps taken. Counts grow
    with each form, so the rounds are at most the logarithm of the digits of a count.
    """
    state = materialize(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = state.join(further, "root", "left")
        state = materialize(
            moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        if state.where("moved").isEmpty():
            return state.select("word", "root")
        state = state.select("word", "root")


def variants(words: DataFrame, dominance: int = DOMINANCE, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of a written table (word, n)."""
    near = materialize(near_words(words, symbols), "near-words")
    forms = materialize(forms_of(near, dominance), "forms")
    return (
        words.join(forms, "word", "left")
        .join(roots_of(forms), "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "form",
            "form_n",
            F.coalesce("root", "word").alias("root"),
        )
    )


def group(docs: DataFrame) -> DataFrame:
    """The variants among the words of whole documents, misspelt by the rule of ``misspelt``."""
    return variants(materialize(vocabulary(noisy_words(docs)), "words"))
