"""Quotients against exact fractions, halves included."""

import random
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import functions as F

from tallyspark.functions.decimals import rounded_quotient


def half_up(value, digits):
    scaled = value * 10**digits
    whole = scaled.numerator // scaled.denominator
    rest = scaled - whole
    return Decimal(whole + (rest >= Fraction(1, 2))).scaleb(-digits)


def test_against_fractions(spark):
    rng = random.Random(1)
    rows = [
        (Decimal("1"), Decimal("3")),
        (Decimal("0.00005"), Decimal("1")),
        (Decimal("0.00004999"), Decimal("1")),
        (Decimal("12.345649999999"), Decimal("1")),
        (Decimal("1"), Decimal("0")),
        (Decimal("0"), Decimal("7")),
        (Decimal("9876543210987654.0123456789"), Decimal("123456789012345.2512345678")),
        (Decimal("1"), Decimal("987654321098765432109876.5")),
    ]
    for _ in range(500):
        a = Decimal(rng.randrange(10 ** rng.randrange(1, 18))).scaleb(-rng.randrange(10))
        b = Decimal(rng.randrange(1, 10 ** rng.randrange(1, 20))).scaleb(-rng.randrange(10))
        rows.append((a, b))
    df = spark.createDataFrame(rows, "a decimal(30,10), b decimal(37,10)")
    found = df.select("a", "b", rounded_quotient(F.col("a"), F.col("b"), 4).alias("q")).collect()
    for r in found:
        expected = half_up(Fraction(r.a) / Fraction(r.b), 4) if r.b else None
        assert r.q == expected, (r.a, r.b)
