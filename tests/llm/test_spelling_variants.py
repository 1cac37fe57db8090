"""Near words, forms and roots against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyspark.llm import spelling_variants as sv
from tallyspark.llm.common import codes
from tallyspark.session import materialize


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long_ = sorted((a, b), key=len)
    return len(long_) == len(short) + 1 and any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def brute_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def brute(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    rows = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, words[w], len(near[w]), form[w], words.get(form[w]), root))
    return sorted(rows)


def edited(rng, word):
    at = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    letter = rng.choice("abcdeÀé÷")
    return word[:at] + (letter if kind else "") + word[at + (kind < 2) :]


def test_a_neighbourhood_holds_every_one_edit_word():
    rng = random.Random(1)
    for _ in range(300):
        word = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 12)))
        near = set(sv.neighbourhood(sv.symbols_of(codes(word))[None, :])[0].tolist())
        for _ in range(20):
            other = edited(rng, word)
            key = sv._sums(sv.symbols_of(codes(other))[None, :])[0][0, -1]
            assert int(key) in near


def test_the_alphabet_is_reduced_to_all_symbols():
    letters = np.array([ord(c) for c in "abcdefghijklmnopqrstuvwxyz"], np.uint32)
    counts = np.bincount(sv.symbols_of(letters).astype(int))
    assert len(counts) == sv.SYMBOLS + 1 and counts[0] == 0 and counts[1:].min() >= 2


def test_documents_against_brute_force(spark):
    rng = random.Random(2)
    stems = ["".join(rng.choice("abcde") for _ in range(rng.randrange(6, 10))) for _ in range(12)]
    words = [*stems, *[edited(rng, s) for s in stems for _ in range(6)], "Überaus", "éàçèùâê", "ab×cdef÷"]
    weights = [60] * len(stems) + [1] * (len(words) - len(stems))
    rows = [(k, rng.choice([" ", ", ", "7"]).join(rng.choices(words, weights, k=40))) for k in range(120)]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (700, None), (701, ""), (702, "7 . 9"), (703, "LONGRUN" * 3000), (704, "LONGRUN" * 3000)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, word int, n string")
    got = sorted(tuple(r) for r in sv.group(docs).collect())
    want = brute(brute_words(rows))
    assert got == want
    assert any(r[3] for r in want) and any(r[2] > 3 for r in want)


def test_chains_and_ties(spark):
    """Forms of forms are followed to the end; equally frequent near words give the smallest."""
    words = {"aaaaaaa": 5000, "aaaaaab": 500, "aaaaabb": 50, "aaaabbb": 5, "zzzzzzz": 40, "zzzzzzé": 40, "zzzzzzx": 4, "zzzzzz": 2}
    table = materialize(spark.createDataFrame(list(words.items()), "word string, n long"), "chain")
    got = sorted(tuple(r) for r in sv.variants(table).collect())
    assert got == brute(words)
    roots = {r[0]: r[5] for r in got}
    assert roots["aaaabbb"] == "aaaaaaa" and roots["zzzzzzx"] == "zzzzzzz"


@pytest.mark.parametrize("symbols", [1, 2, 6, 26])
def test_any_number_of_symbols(spark, symbols):
    rng = random.Random(symbols)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 6))): rng.randrange(2, 200) for _ in range(80)}
    table = materialize(spark.createDataFrame(list(words.items()), "word string, n long"), "symbols")
    assert sorted(tuple(r) for r in sv.variants(table, symbols=symbols).collect()) == brute(words)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sv.group(docs).collect() == []
