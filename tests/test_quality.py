import pytest

from tallyspark.operators import quality
from tallyspark.operators.quality import TableChecks


@pytest.fixture(scope="module")
def child(spark):
    rows = [(1, "a"), (1, "b"), (2, None), (None, "z"), (7, "a"), (7, "z")]
    return spark.createDataFrame(rows, "k int, name string")


def test_the_declared_suite_has_29_checks():
    sizes = [
        (len(c.not_null), len(c.unique), len(c.accepted_values), len(c.relationships))
        for c in quality.SUITE.values()
    ]
    assert [sum(s) for s in zip(*sizes)] == [23, 4, 1, 1]


def test_single_checks(spark, child):
    repeated = {r.k: r.occurrences for r in quality.duplicated_values(child, "k").collect()}
    assert repeated == {1: 2, 7: 2}
    nulls = {r.column_name: r.failures for r in quality.null_counts(child, ["k", "name"]).collect()}
    assert nulls == {"k": 1, "name": 1}
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert [tuple(r) for r in quality.orphans(child, "k", parent, "id").collect()] == [(7, 2)]
    bad = quality.unaccepted_values(child, "name", ["a", "b"]).collect()
    assert [tuple(r) for r in bad] == [("z", 2)]


def test_suite_and_gate(spark, child):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    suite = {
        "child": TableChecks(
            not_null=["k"],
            unique=["k"],
            accepted_values={"name": ["a", "b"]},
            relationships={"k": ("parent", "id")},
        ),
        "parent": TableChecks(not_null=["id"], unique=["id"]),
    }
    report = quality.run_suite({"child": child, "parent": parent}, suite)
    got = {(r.table_name, r.test_name): (r.failures, r.passed) for r in report.collect()}
    assert got == {
        ("child", "not_null"): (1, False),
        ("child", "unique"): (2, False),
        ("child", "accepted_values"): (1, False),
        ("child", "relationships"): (2, False),
        ("parent", "not_null"): (0, True),
        ("parent", "unique"): (0, True),
    }
    with pytest.raises(quality.DataQualityError, match="child.k relationships: 2"):
        quality.gate(report)
    quality.gate(report.where("table_name = 'parent'"))
