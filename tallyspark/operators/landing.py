"""Landing: which rows of a batch enter the raw layer.

Identity is the raw text of ``transaction_id``. Within a batch the first row of
an id wins, ids already present are skipped, and rows without an id always
enter, however many copies there are.

``position`` names columns that order the batch and are unique per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.schemas import RAW_LIMITS
from tallyspark.sources import id_index

ID = "transaction_id"
_SLOT = id_index.SLOT

# A bitmap aggregate holds 32,768 bits; the map has 4,096 of them.
_BLOCK_BITS = 32_768
_MAP_BITS = 4_096 * _BLOCK_BITS


def _with_slot(batch: DataFrame, position: Sequence[str]) -> DataFrame:
    """Add the partitioning key that goes before the id.

    It follows the id where there is one. Rows without an id get one from their
    position, so that a large share of them spreads over all tasks. Sorting by
    a number first is also much cheaper than sorting by text; hashes do not
    compress, so it has 32 bits. The buckets of a stored load follow the same hash of
    slot and id that deals the rows.
    """
    return batch.withColumn(_SLOT, id_index.slot(position))


def _winners(slotted: DataFrame, position: Sequence[str]) -> DataFrame:
    order = [F.when(F.col(ID).isNotNull(), F.col(name)) for name in position]
    window = Window.partitionBy(_SLOT, ID).orderBy(*order)
    return slotted.withColumn("__rank", F.rank().over(window)).where("__rank = 1").drop("__rank")


def _place(bits: Column) -> tuple[Column, Column]:
    """Block and place of an id's bit in a map of ``_MAP_BITS`` bits."""
    return F.shiftright(bits, _BLOCK_BITS.bit_length() - 1), bits.bitwiseAND(F.lit(_BLOCK_BITS - 1))


def _id_map(batch: DataFrame) -> DataFrame:
    """A bit for each id of a batch, in blocks: at most 4,096 rows of 4 kB."""
    block, place = _place(F.pmod(F.xxhash64(ID), F.lit(_MAP_BITS)))
    ids = batch.where(F.col(ID).isNotNull())
    return ids.groupBy(block.alias("__block")).agg(F.bitmap_construct_agg(place).alias("__map"))


def _perhaps_in(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The target's ids whose bit the batch has set: all it shares, and few others.

    The map is broadcast; its size is fixed, whatever the size of batch and target. The
    target is thereby cut where it is read and only what is left of it is shuffled.
    """
    block, place = _place(F.pmod(F.xxhash64(ID), F.lit(_MAP_BITS)))
    ids = target.where(F.col(ID).isNotNull()).select(ID, block.alias("__block"), place.alias("__place"))
    byte = F.substring("__map", (F.shiftright("__place", 3) + 1).cast("int"), F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod("__place", F.lit(8)).cast("int"))
    return ids.join(F.broadcast(_id_map(batch)), "__block").where(bit == 1).select(ID)


def _unseen(slotted: DataFrame, batch: DataFrame, target: DataFrame) -> DataFrame:
    present = _perhaps_in(target, batch).select(F.col(ID), F.hash(ID).alias(_SLOT))
    return slotted.join(present, [_SLOT, ID], "left_anti")


def first_wins(batch: DataFrame, position: Sequence[str]) -> DataFrame:
    """Keep the first row of every id and all rows without id, in one shuffle.

    The rank limit is applied on the map side first, so a hot id sends one row
    per map task. Rows without an id all rank first: they carry no order.
    """
    return _winners(_with_slot(batch, position), position).drop(_SLOT)


def skip_existing(batch: DataFrame, target: DataFrame, position: Sequence[str]) -> DataFrame:
    """Drop rows whose id the target holds already; the target never changes.

    The target may be far larger than the batch, so its id column is first cut
    down by a map of the batch's ids, where it is read. Rows without an id match
    nothing; the slot spreads them.
    """
    return _unseen(_with_slot(batch, position), batch, target).drop(_SLOT)


def land_batch(batch: DataFrame, target: DataFrame | None, position: Sequence[str]) -> DataFrame:
    """First wins within the batch, then skip what the target holds.

    Both steps share one partitioning of the batch.
    """
    return land_slotted(batch, target, position).drop(_SLOT)


def land_slotted(batch: DataFrame, target: DataFrame | None, position: Sequence[str]) -> DataFrame:
    """``land_batch`` with the slot, by which rows are stored without carrying their position."""
    winners = _winners(_with_slot(batch, position), position)
    return winners if target is None else _unseen(winners, batch, target)


def stamp_load(rows: DataFrame, batch_ts: str) -> DataFrame:
    """One constant load time for the whole batch."""
    return rows.withColumn("loaded_at", F.lit(batch_ts).cast("timestamp_ntz"))


def load_metrics(batch: DataFrame, landed: DataFrame) -> DataFrame:
    """One row: rows read, inserted and skipped as duplicates."""
    read = batch.select(F.lit(1).alias("r"), F.lit(0).alias("i"))
    inserted = landed.select(F.lit(0).alias("r"), F.lit(1).alias("i"))
    return read.unionAll(inserted).agg(
        F.coalesce(F.sum("r"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum("i"), F.lit(0)).alias("rows_inserted"),
        F.coalesce(F.sum("r") - F.sum("i"), F.lit(0)).alias("rows_skipped"),
    )


def too_long(column: str) -> Column:
    """Trailing spaces beyond the limit are cut, not counted as excess."""
    return F.length(F.rtrim(F.col(column), F.lit(" "))) > RAW_LIMITS[column]


def enforce_lengths(batch: DataFrame) -> DataFrame:
    """Stop the load on text longer than its column allows."""
    fitted = {}
    for name, limit in RAW_LIMITS.items():
        complaint = F.lit(f"value too long for {name} ({limit})")
        fitted[name] = F.when(too_long(name), F.raise_error(complaint)).otherwise(
            F.substring(F.col(name), 1, limit)
        )
    return batch.withColumns(fitted)


def split_by_length(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit and rows that do not, for loads that set the latter aside."""
    excess = F.lit(False)
    for name in RAW_LIMITS:
        excess = excess | F.coalesce(too_long(name), F.lit(False))
    return batch.where(~excess), batch.where(excess)


def length_report(batch: DataFrame) -> DataFrame:
    """Per column: limit, longest text, and number of values beyond the limit."""
    names = list(RAW_LIMITS)
    facts = batch.agg(
        *[F.coalesce(F.max(F.length(n)), F.lit(0)).alias(f"{n}__max") for n in names],
        *[F.count_if(too_long(n)).alias(f"{n}__bad") for n in names],
    )
    rows = [
        F.struct(
            F.lit(n).alias("column_name"),
            F.lit(RAW_LIMITS[n]).alias("max_allowed"),
            F.col(f"{n}__max").alias("longest"),
            F.col(f"{n}__bad").alias("too_long"),
        )
        for n in names
    ]
    return facts.select(F.inline(F.array(*rows)))
