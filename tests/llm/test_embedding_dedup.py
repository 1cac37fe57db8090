"""Links and components against brute force, with clusters, copies and odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import embedding_dedup as ed

ODD = [
    (9000, None, 1),
    (9001, [0.0] * 16, 1),
    (9002, [1.0] * 15 + [float("nan")], 1),
    (9003, [1.0] * 15 + [None], 1),
    (9004, [1.0] * 16, None),
    (9005, [1.0] * 16, 1),
    (9006, [2.0] * 16, 1),
    (9007, [1.0] * 16, 1),
    (9008, [1.0] * 16, 2),
    (9009, [1.0] * 3, 1),
    (9010, [], 1),
    (9011, [float("inf")] * 16, 1),
]


def vectors(count=1500, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    centres = rng.standard_normal((40, 16))
    for k in range(count):
        if k % 3:
            v = rng.standard_normal(16)
        else:
            c = int(rng.integers(40)) if k % 2 else 0  # centre 0 is a large cluster
            v = centres[c] + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.3])
        rows.append((k, v.astype(np.float32).tolist(), int(rng.integers(2)) + 1))
    return rows + ODD


def brute(rows):
    links = {r[0]: 0 for r in rows}
    component = {r[0]: r[0] for r in rows}
    groups = {}
    for vec_id, v, label in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            groups.setdefault((label, len(v)), []).append((vec_id, v))
    for members in groups.values():
        ids = np.array([m[0] for m in members])
        unit = np.array([m[1] for m in members], np.float32).astype(np.float64)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        near = unit @ unit.T >= ed.THRESHOLD
        labels = ids.copy()
        while not np.array_equal(labels, new := np.array([labels[row].min() for row in near])):
            labels = new
        for vec_id, row, label in zip(ids, near, labels, strict=True):
            links[int(vec_id)], component[int(vec_id)] = int(row.sum()) - 1, int(label)
    return {k: (links[k], component[k], component[k] == k) for k in links}


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit(1))
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ed.deduplicate(df.repartition(4)).collect()}


def test_against_brute_force(spark):
    rows = vectors()
    assert run(spark, rows) == brute(rows)


def test_small_lists_and_windows_still_reach_the_recall(spark, monkeypatch):
    monkeypatch.setattr(ed, "WINDOW", 8)
    monkeypatch.setattr(ed, "ORDERS", 3)
    monkeypatch.setattr(ed, "BLOCK", 16)
    rows = vectors(900, 2)
    found, true = run(spark, rows), brute(rows)
    assert all(found[k][0] <= true[k][0] for k in true)
    assert sum(f[0] for f in found.values()) >= 0.9 * sum(t[0] for t in true.values())


def test_audit_counts_links(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, [0.0, 1.0], 1)]
    nodes = ed.distinct_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    none = spark.createDataFrame([], "a long, b long, cosine double")
    assert ed.audit(nodes, none, 0.93, 10) == (0, 1)
    assert ed.audit(nodes, ed.initial_pairs(nodes, 0.5, 2), 0.93, 10) == (1, 1)


@pytest.mark.parametrize("rows", [[], ODD[:4]])
def test_nothing_to_link(spark, rows):
    assert run(spark, rows) == {r[0]: (0, r[0], True) for r in rows}


def test_repeated_ids(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (0, [1.0, 0.01], 1)]
    assert run(spark, rows) == {1: (2, 0, False), 0: (2, 0, True)}


def test_isolated_pairs_beside_a_large_cluster(spark, monkeypatch):
    """Windows too small for the pairs: the rounds miss the aim and everything is compared."""
    monkeypatch.setattr(ed, "WINDOW", 2)
    monkeypatch.setattr(ed, "ORDERS", 1)
    monkeypatch.setattr(ed, "orders_for", lambda rows, threshold: 1, raising=False)
    monkeypatch.setattr(ed, "MAX_ROUNDS", 1)
    rng = np.random.default_rng(3)
    rows = [(k, v, 1) for k, v in enumerate((np.eye(16)[0] + rng.normal(0, 0.02, (400, 16))).tolist())]
    for k in range(400, 600, 2):
        v = rng.standard_normal(16)
        rows += [(k, v.tolist(), 1), (k + 1, (v + rng.normal(0, 0.2, 16)).tolist(), 1)]
    assert run(spark, rows) == brute(rows)


def test_orders_grow_with_rows():
    assert ed.orders_for(100, 0.93) == ed.ORDERS
    assert ed.orders_for(10**6, 0.93) > ed.orders_for(10**5, 0.93) > ed.ORDERS


def test_saturated_lists_reach_other_clusters(spark, monkeypatch):
    """Two dense clusters that touch in one pair, which no window holds."""
    rng = np.random.default_rng(4)
    x, y = np.eye(16)[0], np.eye(16)[1]
    turned = lambda angle: np.cos(angle) * x + np.sin(angle) * y
    angle = float(np.arccos(ed.THRESHOLD))
    near = [turned(0) + rng.normal(0, 0.002, 16) for _ in range(60)]
    far = [turned(1.12 * angle) + rng.normal(0, 0.002, 16) for _ in range(60)]
    rows = [(k, v.tolist(), 1) for k, v in enumerate([*near, turned(0.1 * angle), turned(1.05 * angle), *far])]
    true = brute(rows)
    assert {t[1] for t in true.values()} == {0}
    monkeypatch.setattr(ed, "audit_components", lambda rows, _: (1.0, rows.limit(0).selectExpr("node a", "node b", "0D cosine")), raising=False)
    start = ed.initial_pairs
    monkeypatch.setattr(ed, "initial_pairs", lambda *given: start(*given).where("cosine >= 0.97"))
    walked = ed.descend
    monkeypatch.setattr(ed, "descend", lambda nodes, pairs, floor, size: walked(nodes, pairs, 0.97, size))
    assert run(spark, rows) == true
