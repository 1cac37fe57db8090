"""Exact quotients of decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_quotient(part: Column, whole: Column, digits: int) -> Column:
    """part / whole for values of at least zero, rounded half up once; NULL for a whole of zero.

    Spark's division rounds to the scale its type has room for, and rounding that again
    may cross a half. Remainders are exact: they give the quotient digit by digit.
    """
    divisor = F.nullif(whole, F.lit(0))
    rest = part % divisor
    units = (part - rest) / divisor
    scaled = rest * F.lit(10**digits)
    last = scaled % divisor
    fraction = (scaled - last) / divisor + F.when(last * 2 >= divisor, 1).otherwise(0)
    step = F.lit(f"0.{'0' * (digits - 1)}1").cast(f"decimal({digits},{digits})")
    return units.cast(f"decimal({38 - digits},0)") + fraction.cast("decimal(6,0)") * step
