"""Connected components against a union of sets."""

import random

from tallyspark.llm.common import connected_components


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 160)]  # a long path
    edges += [(500, 500 + k) for k in range(1, 40)]  # a star
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((top(a), top(b)))
            parent[high] = low
    assert {r.node: r.component for r in found.collect()} == {x: top(x) for x in list(parent)}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []
