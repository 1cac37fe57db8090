"""Groups of near copies against comparing all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import common, jaccard_join as jj

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    (9000, None), (9001, ""), (9002, " \n\t"), (9003, "a b"), (9004, "A  B"), (9005, "a b c"), (9006, "é É"),
    (9007, "É é"), (9008, "a b c d e"), (9009, "a b c d e f"), (9010, "x y z"), (9011, "a b c d e"),
]


def edited(words, rng, vocabulary, edits):
    words = list(words)
    for _ in range(edits):
        k, kind = rng.randrange(len(words)), rng.random()
        if kind < 0.5:
            words[k] = rng.choice(vocabulary)
        elif kind < 0.75 and len(words) > 2:
            del words[k]
        else:
            words.insert(k, rng.choice(vocabulary))
    return words


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = list(ODD)
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 150))]
        if rng.random() < 0.5:
            base = passage + base
        now = base
        for _ in range(rng.randrange(1, 12)):
            now = edited(now if rng.random() < 0.7 else base, rng, vocabulary, rng.choice([0, 1, 1, 2, 3]))
            rows.append((len(rows), " ".join(now)))
    return rows


def sets_of(rows, width=5):
    out = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
        count = max(1, len(words) - width + 1) if words else 0
        out.append((doc_id, frozenset(tuple(words[i : i + width]) for i in range(count))))
    return out


def brute(rows):
    sets = sets_of(rows)
    parent = list(range(len(sets)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = set()
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                links.add((i, j))
                parent[top(i)] = top(j)
    least = {}
    for k, (doc_id, _) in enumerate(sets):
        least[top(k)] = min(least.get(top(k), doc_id), doc_id)
    return [(doc_id, len(s), least[top(k)]) for k, (doc_id, s) in enumerate(sets)], links, sets


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("own")).repartition(5)


@pytest.mark.parametrize("seed", [5, 6])
def test_groups(spark, seed):
    rows = corpus(seed)
    expected, links, _ = brute(rows)
    assert len(links) > 100
    found = jj.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(expected)


def test_search_alone_closes_every_group(spark, monkeypatch):
    """Without leaders each set is its own component, so the search has to find all."""
    monkeypatch.setattr(jj, "ENTRIES_TOGETHER", 200)
    monkeypatch.setattr(jj, "HASHES_TOGETHER", 3000)
    rows = corpus(7)
    expected, links, _ = brute(rows)
    docs = frame(spark, rows)
    chosen = jj.candidates(jj.first_pass(docs, jj.WIDTH))
    kept = jj.candidate_sets(docs, chosen, jj.WIDTH)
    alone = kept.select("node", F.col("node").alias("component"))
    found = {(r.a, r.b) for r in jj.search(kept, alone).collect()}
    names = {r.node: bytes(r.key) for r in kept.select("node", "key").collect()}
    key = [jj.set_key(common.shingles(text or "", jj.WIDTH)) for _, text in rows]
    true = {frozenset((key[i], key[j])) for i, j in links if key[i] != key[j]}
    assert {frozenset((names[a], names[b])) for a, b in found} == true
    assert len(true) > 50


def test_small_tasks_settle_the_same(spark, monkeypatch):
    monkeypatch.setattr(jj, "FLUSH", 500)
    monkeypatch.setattr(jj, "LIST_CHUNK", 3)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(jj, "QUERIES_TOGETHER", 2)
    monkeypatch.setattr(jj, "HITS_SHARE", 3)
    monkeypatch.setattr(jj, "HASHES_TOGETHER", 2000)
    rows = corpus(8)
    found = jj.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(brute(rows)[0])


def test_heap_merge_and_probe():
    rng = random.Random(1)
    lists = [np.array(sorted(rng.sample(range(50), rng.randrange(1, 30)))) for _ in range(12)]
    counts = Counter(x for entries in lists for x in entries.tolist())
    for least in (1, 3, 7):
        assert dict(jj.merge_short_lists(lists, least)) == {k: v for k, v in counts.items() if v >= least}
    assert jj.probe(np.array([1, 5, 9, 13]), np.array([0, 5, 9, 12])).tolist() == [False, True, True, False]
    assert jj.probe(np.array([1]), np.array([], np.int64)).tolist() == [False]


def test_shingle_sizes():
    for _, text in corpus(9):
        assert len(common.shingles(text or "", 5)) == len(sets_of([(0, text)])[0][1])


def test_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(3, text), (2, text.upper()), (1, "other words"), (2, text.upper()), (7, None), (None, text), (None, "alone")]
    kept = jj.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted(
        [(1, "other words"), (2, text.upper()), (2, text.upper()), (7, None), (None, "alone")], key=repr
    )


def test_empty(spark):
    assert jj.near_duplicates(frame(spark, [])).collect() == []
