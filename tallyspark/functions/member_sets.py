"""Sets of whole numbers as containers of 32,768 neighbours each, which merge by union.

A set is spread over rows (key, bucket, members): the bucket is the number without its last
15 bits and the members are those bits, sorted. No row has more than 32,768 members, so a
set of any size is built, merged and counted without one task holding it whole. Only the
cell that shows all members of a key has the size of the set.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 15

NAME, BUCKET, MEMBERS = "set_name", "bucket", "members"


def containers(rows: DataFrame, keys: Sequence[str], sets: Mapping[str, str]) -> DataFrame:
    """The containers of the named sets (name -> column) of every key; NULL is no member.

    One shuffle: tasks send their part of a container, which holds each member once, and no
    container has more than 32,768 of them. A hot key spreads over its containers.
    """
    values = F.array(*[F.struct(F.lit(name).alias(NAME), F.col(column).cast("long").alias("v")) for name, column in sets.items()])
    present = rows.select(*keys, F.inline(values)).where("v IS NOT NULL")
    low = F.col("v").bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")
    return present.groupBy(*keys, NAME, F.shiftright("v", _BITS).alias(BUCKET)).agg(
        F.sort_array(F.collect_set(low)).alias(MEMBERS)
    )


def union(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One container for each key, set and bucket."""
    together = F.array_distinct(F.flatten(F.collect_list(MEMBERS)))
    return parts.groupBy(*keys, NAME, BUCKET).agg(F.sort_array(together).alias(MEMBERS))


def size_of(name: str) -> Column:
    """Members of a set; an aggregate over the containers of a key."""
    return F.coalesce(F.sum(F.when(F.col(NAME) == name, F.size(MEMBERS).cast("long"))), F.lit(0).cast("long"))


def members_of(name: str, kind: str = "int") -> Column:
    """All members of a set in order; an aggregate over the containers of a key."""
    own = F.sort_array(F.collect_list(F.when(F.col(NAME) == name, F.struct(BUCKET, MEMBERS))))
    return F.flatten(
        F.transform(own, lambda c: F.transform(c[MEMBERS], lambda low: (c[BUCKET] * (1 << _BITS) + low).cast(kind)))
    )
