"""An index of the ids of each stored load: which buckets may hold an id.

A load is stored in buckets by the hash of slot and id that deals a landing's rows to tasks, so
that a task holds few buckets and the rows need no second shuffle. The index has, for each bucket, blocks of
``SLICES`` bitmaps, and each id sets one bit in every bitmap of its block (a Bloom filter of
64 bits an id). Bitmaps are built by aggregates that merge partial ones by bitwise or, so no
task gathers ids, and a hot id sets the bits it has set before. An id that is not stored
passes all bitmaps of a full block in 4 of 10**8 cases; a hit only means that the bucket is
read, so results are exact.

Loads of the same size class share a geometry, a number of buckets and of blocks. A batch
meets the index by equality of geometry, bucket and block. Rows without id are in no bitmap
and in no look-up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID = "transaction_id"
SLOT = "__slot"

# A bitmap aggregate holds 32,768 bits; ids take 15 bits of a hash each.
SLICES = 8
_PLACE_BITS = 15
_BLOCK_BITS = 1 << _PLACE_BITS

# At eight bits an id and bitmap a block is full with these; a bucket has so many blocks at most.
BLOCK_IDS = _BLOCK_BITS // 8
BUCKET_BLOCKS = 1_024

_MAPS = [f"map_{k}" for k in range(SLICES)]
_KEYS = ["buckets", "blocks", "id_bucket", "block"]
SCHEMA = T.StructType(
    [T.StructField(name, T.LongType()) for name in _KEYS] + [T.StructField(name, T.BinaryType()) for name in _MAPS]
)


def _power(least: int) -> int:
    """The smallest power of two that is not less."""
    return 1 << max(least - 1, 0).bit_length()


def geometry(rows: int, tasks: int = 1) -> tuple[int, int]:
    """Buckets of a load and blocks of each bucket for at most so many rows.

    Rows that ``tasks`` tasks hold by their hash get a number of buckets that divides theirs
    or is a multiple of it, and so many blocks that none is spread over several tasks.
    """
    cells = _power(-(-rows // BLOCK_IDS))
    buckets = max(cells // BUCKET_BLOCKS, 1)
    if cells >= tasks:
        cells = tasks * _power(-(-cells // tasks))
        if tasks % buckets:
            buckets = tasks * _power(-(-buckets // tasks))
    return buckets, max(cells // buckets, 1)


def slot(position: Sequence[str]) -> Column:
    """A hash of the id, or of the row's position where it has none."""
    return F.when(F.col(ID).isNull(), F.hash(*position)).otherwise(F.hash(ID))


def bucket_of(buckets: int, position: Sequence[str], at: Column | None = None) -> Column:
    """The bucket of a row: by its id, or by its position where it has none; ``at`` is its slot if known."""
    return F.pmod(F.hash(slot(position) if at is None else at, ID), F.lit(buckets)).cast("long")


def _block(buckets: int, blocks: int) -> Column:
    """The block of an id in its bucket, by the hash that gives the bucket."""
    cell = F.pmod(F.hash(F.hash(ID), ID), F.lit(buckets * blocks))
    return F.floor(cell / buckets).cast("long")


def _hashes() -> list[Column]:
    return [F.xxhash64(F.lit(seed), ID) for seed in (2, 3)]


def _places(hashes: Sequence[Column]) -> list[Column]:
    """The bit of an id in each of the bitmaps of its block, by its two hashes."""
    return [
        F.shiftrightunsigned(h, _PLACE_BITS * k).bitwiseAND(F.lit(_BLOCK_BITS - 1))
        for h in hashes
        for k in range(SLICES // 2)
    ]


def build(rows: DataFrame, buckets: int, blocks: int) -> DataFrame:
    """The index of one stored load from its columns transaction_id and id_bucket.

    A row without bitmaps, in no bucket, tells that the load is indexed though it may have no ids.
    """
    marker = rows.sparkSession.createDataFrame([(buckets, blocks, -1, -1, *[None] * SLICES)], SCHEMA)
    found = (
        rows.where(F.col(ID).isNotNull())
        .groupBy(F.lit(buckets).cast("long").alias("buckets"), F.lit(blocks).cast("long").alias("blocks"),
                 "id_bucket", _block(buckets, blocks).alias("block"))
        .agg(*[F.bitmap_construct_agg(place).alias(name) for place, name in zip(_places(_hashes()), _MAPS, strict=True)])
    )
    return found.unionByName(marker)


def _words(bitmap: str) -> Column:
    """A bitmap as the longs of its bytes, first byte highest: a row's array is read in place, its bytes are copied."""
    word = F.sequence(F.lit(0), F.lit(_BLOCK_BITS // 64 - 1))
    return F.transform(
        word, lambda k: F.conv(F.hex(F.substring(bitmap, k * 8 + 1, F.lit(8))), 16, -10).cast("long")
    )


def _is_set(words: str, place: Column) -> Column:
    """The bit of a place: bits are counted from the lowest of a byte, bytes from the highest of a word."""
    word = F.get(words, F.shiftright(place, 6).cast("int"))
    return F.getbit(word, place.bitwiseXOR(F.lit(56)).bitwiseAND(F.lit(63)).cast("int")) == 1


def hits(index: DataFrame, batch: DataFrame) -> DataFrame:
    """(load_id, id_bucket) of every bucket that may hold an id of the batch.

    The batch's ids are made distinct first, so a hot one asks once. The classes of loads
    are a handful of numbers.
    """
    classes = [tuple(row) for row in index.select("buckets", "blocks").distinct().collect()]
    if not classes:
        return index.select("load_id", "id_bucket")
    looked_up = [
        F.struct(
            F.lit(buckets).alias("buckets"),
            F.lit(blocks).alias("blocks"),
            bucket_of(buckets, [ID]).alias("id_bucket"),
            _block(buckets, blocks).alias("block"),
        )
        for buckets, blocks in classes
    ]
    # Two hashes travel to the bitmaps, not the eight places they give.
    hashes = [h.alias(f"hash_{k}") for k, h in enumerate(_hashes())]
    ids = batch.where(F.col(ID).isNotNull()).select(ID).distinct()
    asked = ids.select(F.inline(F.array(*looked_up)), *hashes)
    found = F.lit(True)
    for name, place in zip(_MAPS, _places([F.col("hash_0"), F.col("hash_1")]), strict=True):
        found = found & _is_set(name, place)
    # Once for each block, not for each id that is looked up in it.
    words = index.select("load_id", *_KEYS, *[_words(name).alias(name) for name in _MAPS])
    return asked.join(words, _KEYS).where(found).select("load_id", "id_bucket").distinct()


def candidates(index: DataFrame, batch: DataFrame) -> dict[str, list[int]]:
    """The buckets of each load that may hold an id of the batch: names of partitions."""
    found: dict[str, list[int]] = {}
    for row in hits(index, batch).collect():
        found.setdefault(row.load_id, []).append(row.id_bucket)
    return {load: sorted(buckets) for load, buckets in found.items()}
