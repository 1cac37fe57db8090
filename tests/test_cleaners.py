"""Edge cases of every cleaner, in both modes."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyspark.functions import cleaners as c

RAISES = "raises"
DAY = dt.date(2023, 7, 15)

IDS = {
    "T1001": 1001,
    "1001": 1001,
    " 1001 ": 1001,
    None: None,
    "": None,
    "T": None,
    "t1001": RAISES,
    "ABC": RAISES,
    "1001.0": RAISES,
    "TT5": RAISES,
    "99999999999": RAISES,
}
CUSTOMERS = {
    "501.0": 501,
    "501": 501,
    "501.9": 501,
    " 501": 501,
    None: None,
    "": RAISES,
    ".5": RAISES,
    "abc": RAISES,
}
DATES = {
    "2023-07-15": DAY,
    "15-07-2023": DAY,
    "2024-02-29": dt.date(2024, 2, 29),
    "2023/07/15": None,
    "2023-7-5": None,
    "": None,
    None: None,
    "15-07-2023\n": None,
    "07-15-2023": RAISES,
    "31-02-2023": RAISES,
    "2023-02-29": RAISES,
}
QUANTITIES = {
    "3": 3,
    "3.0": 3,
    "2.5": 3,
    "3.4": 3,
    "2.4999999": 2,
    "2.49999999999999999999999999": 2,
    "0.5": 1,
    "0": 0,
    "00000000000000000000000000007": 7,
    "2147483647": 2147483647,
    "2147483647.4": 2147483647,
    "-1": None,
    "+1": None,
    "few": None,
    "": None,
    None: None,
    "1e3": None,
    " 3": None,
    ".5": None,
    "5.": None,
    "1,000": None,
    "12\n": None,
    "2147483647.5": RAISES,
    "3000000000": RAISES,
    "99999999999999999999999999": RAISES,
}
AMOUNTS = {
    "100": Decimal("100"),
    "100.50": Decimal("100.5"),
    "0": Decimal("0"),
    "007": Decimal("7"),
    "-5": None,
    "Two Hundred": None,
    "": None,
    None: None,
    "33.1234567": Decimal("33.1234567"),
    "33.12345678910000000000": Decimal("33.1234567891"),
    "123456789012345.25": Decimal("123456789012345.25"),
    "00000000001234567890123456": Decimal("1234567890123456"),
}
# Numbers that no amount holds exactly: they stop both modes.
TOO_LONG = ("12345678901234567", "1.12345678901", "0.00000000001", "12345678901234567.5")
CLEANERS = {
    "id": (IDS, lambda col, mode: c.clean_prefixed_id(col, "T", "transaction_id", mode)),
    "customer": (CUSTOMERS, c.clean_customer_id),
    "date": (DATES, c.clean_date),
    "quantity": (QUANTITIES, c.clean_quantity),
    "amount": (AMOUNTS, lambda col, mode: c.clean_amount(col, "price", mode)),
}


@pytest.mark.parametrize("name", CLEANERS)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lenient(spark, name, ansi):
    cases, clean = CLEANERS[name]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([[t] for t in cases], "t string")
        got = {r.t: r.v for r in df.select("t", clean(F.col("t"), c.LENIENT).alias("v")).collect()}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert got == {t: None if v == RAISES else v for t, v in cases.items()}


@pytest.mark.parametrize("name", CLEANERS)
def test_strict_equals_lenient_where_it_accepts(spark, name):
    cases, clean = CLEANERS[name]
    accepted = {t: v for t, v in cases.items() if v != RAISES}
    df = spark.createDataFrame([[t] for t in accepted], "t string")
    got = {r.t: r.v for r in df.select("t", clean(F.col("t"), c.STRICT).alias("v")).collect()}
    assert got == accepted


@pytest.mark.parametrize(
    "name,text", [(n, t) for n, (cases, _) in CLEANERS.items() for t, v in cases.items() if v == RAISES]
)
def test_strict_refuses(spark, name, text):
    df = spark.createDataFrame([[text]], "t string")
    with pytest.raises(PySparkException, match="cannot convert"):
        df.select(CLEANERS[name][1](F.col("t"), c.STRICT)).collect()


@pytest.mark.parametrize("mode", [c.LENIENT, c.STRICT])
@pytest.mark.parametrize("text", TOO_LONG)
def test_an_amount_is_never_rounded_or_lost(spark, text, mode):
    df = spark.createDataFrame([[text]], "t string")
    with pytest.raises(PySparkException, match=f"price: too many digits in '{text}'"):
        df.select(c.clean_amount(F.col("t"), "price", mode)).collect()


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        c.clean_date(F.col("t"), "loose")
    with pytest.raises(ValueError):
        c.clean_amount(F.col("t"), "price", "loose")


def test_digit_loss(spark):
    texts = {
        "1.1234567891": False,
        "1.12345678910": False,
        "1.12345678911": True,
        "1234567890123456": False,
        "001234567890123456": False,
        "12345678901234567": True,
        "abc": False,
        None: False,
    }
    df = spark.createDataFrame([[t] for t in texts], "t string")
    got = {r.t: r.v for r in df.select("t", c.loses_digits(F.col("t")).alias("v")).collect()}
    assert got == texts
