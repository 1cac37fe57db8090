"""Rankings compared in order."""

import os

import compare
import pytest

from tallyspark.operators import ranking
from tallyspark.plans import queries as catalog

SF_DIR = "/root/testdata/sf0.001"


def test_ranked_orders_by_measure_then_key(spark):
    rows = [(3, None), (2, 5), (None, 5), (1, 5), (4, 9), (5, 0)]
    df = spark.createDataFrame(rows, "k int, m int").repartition(4)
    assert [(r.k, r.m) for r in ranking.ranked(df, "m", ["k"]).collect()] == [
        (4, 9), (1, 5), (2, 5), (None, 5), (5, 0), (3, None),
    ]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")
@pytest.mark.parametrize(
    "name",
    ["rank_customers_by_revenue", "rank_customers_by_transactions", "rank_products_by_revenue", "rank_products_by_units"],
)
def test_registered_rankings_in_order(spark, name):
    df = catalog.queries()[name](spark, SF_DIR)
    rows = [tuple(map(compare.plain, r)) for r in df.collect()]
    cursor = compare.connect(SF_DIR).execute(catalog.oracle_sql()[name])
    places = [[d[0] for d in cursor.description].index(c) for c in df.columns]
    assert rows == [tuple(compare.plain(r[k]) for k in places) for r in cursor.fetchall()]
