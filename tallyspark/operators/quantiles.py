"""Exact quantiles with linear interpolation, without one task per group.

A group may hold most of the rows, so its values are never gathered. Values
fall into order-preserving buckets of 0.1 % relative width. The number of
buckets depends on the magnitudes that occur and not on the number of rows, so
the bucket totals of a group are a small table. They locate the bucket of each
wanted rank, and only those buckets are looked at value by value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUARTILES = (0.25, 0.5, 0.75)
QUARTILE_NAMES = ("q25", "q50", "q75")

_BUCKETS_PER_E_FOLD = 1000
# Above |ln(x)| * 1000 for every double, so that the sign decides first.
_SIGN_OFFSET = 1_000_000


def bucket_of(value: Column) -> Column:
    """Bucket number; a larger value never has a smaller number. Never NULL."""
    step = F.floor(F.ln(F.abs(value)) * _BUCKETS_PER_E_FOLD) + _SIGN_OFFSET
    signed = F.when(value > 0, step).when(value < 0, -step)
    return F.coalesce(signed.cast("bigint"), F.lit(0).cast("bigint"))


def edge_of(bucket: Column) -> Column:
    """The value nearest to zero that falls into a bucket, up to rounding."""
    size = F.exp((F.abs(bucket) - _SIGN_OFFSET) / _BUCKETS_PER_E_FOLD)
    return F.when(bucket > 0, size).when(bucket < 0, -size).otherwise(F.lit(0.0))


def range_of(bucket: Column) -> Column:
    """Number of the factor of e a bucket lies in; doubles have fewer than 3,000 of them."""
    return F.floor(bucket / _BUCKETS_PER_E_FOLD).cast("int")


def bucket_sums(counts: DataFrame, group: str) -> DataFrame:
    """Mergeable totals of ``value_counts`` by group and bucket.

    Deviations are taken from the edge of the bucket, which is the same in every part and at
    most 0.1 % away, so that plain sums neither cancel nor need the mean.
    """
    off = F.col("value") - edge_of(F.col("bucket"))
    return counts.groupBy(group, "bucket").agg(
        F.sum("n").alias("in_bucket"),
        F.sum(F.col("n") * off).alias("off"),
        F.sum(F.col("n") * off * off).alias("off_squares"),
        F.min("value").alias("bucket_min"),
        F.max("value").alias("bucket_max"),
    )


def merged_sums(parts: DataFrame, group: str) -> DataFrame:
    """One row per group and bucket from ``bucket_sums`` of any parts, with mean and variance."""
    sums = parts.groupBy(group, "bucket").agg(
        *[F.sum(c).alias(c) for c in ("in_bucket", "off", "off_squares")],
        F.min("bucket_min").alias("bucket_min"),
        F.max("bucket_max").alias("bucket_max"),
    )
    off = F.col("off") / F.col("in_bucket")
    return sums.withColumns(
        {
            "bucket_mean": edge_of(F.col("bucket")) + off,
            "bucket_variance": F.greatest(F.col("off_squares") / F.col("in_bucket") - off * off, F.lit(0.0)),
        }
    )


def present(rows: DataFrame, group: str) -> DataFrame:
    """(group, value, bucket) of the rows that have both."""
    value = F.col("value")
    known = F.col(group).isNotNull() & value.isNotNull() & ~F.isnan(value)
    return rows.where(known).withColumn("bucket", bucket_of(value))


def value_counts(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, n, bucket): how often each value occurs in each group."""
    pairs = df.select(group, F.col(value).cast("double").alias("value"))
    known = F.col(group).isNotNull() & F.col("value").isNotNull() & ~F.isnan("value")
    counts = pairs.where(known).groupBy(group, "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("bucket", bucket_of(F.col("value")))


def _places(probabilities: Sequence[float]) -> list[tuple[Column, Column, Column]]:
    """Per probability: p * (rows - 1) and its neighbouring ranks, from zero."""
    last = F.col("all_rows") - 1
    result = []
    for p in probabilities:
        place = F.lit(float(p)) * last
        lower = F.floor(place).cast("bigint")
        result.append((place, lower, F.least(lower + 1, last)))
    return result


def locate(totals: DataFrame, group: str, probabilities: Sequence[float] = QUARTILES) -> DataFrame:
    """Keep the buckets that hold a wanted rank.

    ``totals`` has one row per group and bucket with the number of its rows in
    ``in_bucket``. Added are ``before``, the rows in lower buckets, and
    ``all_rows``. At most two buckets per probability and group remain.
    """
    running = Window.partitionBy(group).orderBy("bucket")
    counted = totals.withColumn(
        "before", F.sum("in_bucket").over(running) - F.col("in_bucket")
    ).withColumn("all_rows", F.sum("in_bucket").over(Window.partitionBy(group)))
    first, end = F.col("before"), F.col("before") + F.col("in_bucket")
    wanted = F.lit(False)
    for _, lower, upper in _places(probabilities):
        for rank in (lower, upper):
            wanted = wanted | ((rank >= first) & (rank < end))
    return counted.where(wanted)


def interpolate(
    counts: DataFrame,
    group: str,
    probabilities: Sequence[float] = QUARTILES,
    names: Sequence[str] = QUARTILE_NAMES,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(group, *names, *carry) from the value counts of the located buckets.

    ``counts`` has group, bucket, value and n, and what ``locate`` added.
    ``carry`` names columns that are the same in all rows of a group.
    """
    ordered = Window.partitionBy(group, "bucket").orderBy("value")
    ranked = counts.withColumn("end", F.col("before") + F.sum("n").over(ordered))

    def value_at(rank: Column) -> Column:
        covers = (rank >= F.col("end") - F.col("n")) & (rank < F.col("end"))
        return F.max(F.when(covers, F.col("value")))

    parts, results = [], []
    for name, (place, lower, upper) in zip(names, _places(probabilities)):
        parts += [
            value_at(lower).alias(f"{name}__lo"),
            value_at(upper).alias(f"{name}__hi"),
            F.max(place - lower).alias(f"{name}__part"),
        ]
        low, high, part = (F.col(f"{name}__{x}") for x in ("lo", "hi", "part"))
        results.append((low + (high - low) * part).alias(name))
    found = ranked.groupBy(group).agg(*parts, *[F.max(c).alias(c) for c in carry])
    return found.select(group, *results, *carry)


def quantiles_of(
    totals: DataFrame,
    read: Callable[[DataFrame], DataFrame],
    group: str,
    probabilities: Sequence[float] = QUARTILES,
    names: Sequence[str] = QUARTILE_NAMES,
) -> DataFrame:
    """(group, *names) from bucket totals; ``read`` joins value counts to wanted buckets."""
    chosen = locate(totals, group, probabilities).select(group, "bucket", "before", "all_rows")
    return interpolate(read(chosen), group, probabilities, names)


def quantiles(
    counts: DataFrame,
    group: str,
    probabilities: Sequence[float] = QUARTILES,
    names: Sequence[str] = QUARTILE_NAMES,
) -> DataFrame:
    """(group, *names) for any number of groups, from ``value_counts``."""
    totals = counts.groupBy(group, "bucket").agg(F.sum("n").alias("in_bucket"))
    return quantiles_of(totals, lambda chosen: counts.join(chosen, [group, "bucket"]), group, probabilities, names)
