"""The index against all codes, results against brute force, and the recall."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import hashed_search as hs

SCHEMA = "vec_id long, embedding array<float>, label string, rank int, score string"


def table_of(spark, vectors):
    return spark.createDataFrame([(i, v, "x", 1, "y") for i, v in vectors], SCHEMA)


def brute(vectors, k, modulus=20):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in vectors]
    rows = {}
    for query, q in usable:
        if query % modulus == 0:
            scored = sorted((-float((q * v).sum()), i) for i, v in usable if i != query)
            rows[query] = [(i, -minus) for minus, i in scored[:k]]
    return rows


def result(df):
    rows = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(rows.setdefault(r.query_id, [])) + 1
        rows[r.query_id].append((r.vec_id, r.score))
    return rows


@pytest.mark.parametrize("bits,radius", [(64, 0), (64, 3), (64, 11), (128, 20), (128, 45), (64, 64)])
def test_the_index_finds_every_code_within_the_radius(bits, radius):
    rng = np.random.default_rng(bits + radius)
    codes = rng.integers(0, 256, (3000, bits // 8)).astype(np.uint8)
    codes[100:400] = codes[7]
    for k in range(400, 700):
        flipped = np.unpackbits(codes[8])
        flipped[rng.choice(bits, rng.integers(0, max(radius, 1) + 3) % bits, replace=False)] ^= 1
        codes[k] = np.packbits(flipped)
    index = hs.MultiIndex(codes)
    for row in (7, 8, 500, 2999):
        distance = np.bitwise_count(codes ^ codes[row]).sum(axis=1)
        want = np.flatnonzero(distance <= radius)
        assert (index.within(codes[row].view("<u2"), radius) == want).all()


def test_few_rows_are_touched_within_a_small_radius():
    codes = np.random.default_rng(1).integers(0, 256, (20_000, 16)).astype(np.uint8)
    index = hs.MultiIndex(codes)
    touched = [len(index.candidates(codes[k].view("<u2"), 8)) for k in range(20)]
    assert max(touched) < len(codes) / 100


def test_rotations_are_orthogonal_and_fit_the_sample():
    rng = np.random.default_rng(2)
    x = hs.for_index(rng.standard_normal((500, 8)), 10.0)
    directions = hs.learn(x, 64)
    assert directions.shape == (9, 64)
    first = directions[:, :9]
    assert np.allclose(first.T @ first, np.eye(9))
    assert np.allclose(np.linalg.norm(x, axis=1), 1)


def test_against_brute_force(spark):
    """Copies, ties, norms of all sizes: few rows, so the radius covers what there is."""
    rng = random.Random(3)
    base = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(60)]
    vectors = list(enumerate(base)) + [(100 + k, base[0]) for k in range(150)]
    vectors += [(300 + k, [x * 10.0 ** (k % 5 - 2) for x in base[k]]) for k in range(40)]
    got, want = result(hs.search(table_of(spark, vectors), F.col("vec_id") % 20 == 0)), brute(vectors, 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    scores = {(q, i): s for q, v in want.items() for i, s in v}
    for q, found in got.items():
        assert len(found) == 20 and q not in [i for i, _ in found]
        assert found == sorted(found, key=lambda pair: (-pair[1], pair[0]))
        assert all(s == pytest.approx(scores.get((q, i), s), rel=1e-12) for i, s in found)
    # A query that many rows copy has the copies of the smallest ids.
    assert [i for i, _ in got[100]] == [i for i, _ in want[100]]


def test_recall_on_vectors_without_structure(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    vectors = [(k, row.tolist()) for k, row in enumerate(x)]
    got, want = result(hs.search(table_of(spark, vectors), F.col("vec_id") % 20 == 0)), brute(vectors, 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.93 * 20 * len(want) and all(len(found) == 20 for found in got.values())


def test_queries_without_near_codes_widen(spark):
    """One query far from a dense group still gets its neighbours."""
    rng = random.Random(5)
    dense = [[1.0 + rng.gauss(0, 1e-3) for _ in range(16)] for _ in range(800)]
    vectors = list(enumerate(dense)) + [(1000, [-1.0] * 16)]
    got = result(hs.search(table_of(spark, vectors), F.col("vec_id") % 20 == 0))
    assert len(got[1000]) == 20 and len(got) == 41


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [0.5, -0.0]), (3, [0.6, 0.0]), (3, [0.5, 0.0])]
    odd = [(40, None), (60, []), (80, [0.0, 0.0]), (100, [nan, 1.0]), (120, [inf, 1.0]), (140, [None, 1.0]), (None, [1.0, 1.0]), (160, [1.0])]
    got = result(hs.search(table_of(spark, vectors + odd), F.col("vec_id") % 20 == 0))
    assert got == {0: [(3, 0.5), (20, 0.0)], 20: [(0, 0.0), (3, 0.0)]}


@pytest.mark.parametrize("vectors", [[], [(1, [1.0])], [(20, [1.0])], [(20, None)]])
def test_nothing_to_find(spark, vectors):
    df = hs.search(table_of(spark, vectors), F.col("vec_id") % 20 == 0)
    assert df.columns == ["query_id", "rank", "vec_id", "score"] and df.collect() == []
