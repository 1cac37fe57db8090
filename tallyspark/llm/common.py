"""Helpers of the corpus operators: tables, text arrays, label splits, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import materialize

FOLDS = 5
HELD_OUT_FOLD = 0

# Longer keys are not remembered.
CACHED_CHARS = 48

# A side of at most this many rows of two numbers is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 1_000_000

# Rows of one Arrow batch: with texts of 100 kB a batch stays near 50 MB.
BATCH_ROWS = 500

_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Memo(dict):
    """Values made on first use. When there are ``limit``, only those used again stay."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.former = make, limit, {}

    def __missing__(self, key):
        value = self.former.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > CACHED_CHARS:
                return value
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.limit:
            self.former = dict(self)
            self.clear()
        self[key] = value

    def recalled(self, keys) -> dict:
        """Those of the keys that only the former values hold, with their values."""
        former = self.former
        return {key: former[key] for key in keys if key in former}

    def add(self, entries: dict) -> None:
        if len(self) + len(entries) > self.limit:
            self.former = dict(self)
            self.clear()
        self.update(entries)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Arrow batches that carry whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def short_reads(spark: SparkSession) -> None:
    """Bound the memory of the column vectors that texts are read into: a vector holds a whole batch of them."""
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(BATCH_ROWS))


_kept: dict = {}


def keep(key, make):
    """A large table of this process, made on first use and kept for its next tasks; only one at a time."""
    if key not in _kept:
        forget()
        _kept[key] = make()
        release()
    return _kept[key]


def forget() -> None:
    """Let go of the table of an earlier operator: Spark hands a worker on to the next one's tasks."""
    if _kept:
        _kept.clear()
        gc.collect()
        release()


def release() -> None:
    """Give freed memory back, so that an idle worker does not hold what its last task needed."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds; null ids are in the held-out fold."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == HELD_OUT_FOLD


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents outside the held-out fold.

    The rows with the smallest hash of their id are taken, so the choice does not
    depend on partitions. The ids are broadcast: ``rows`` bounds them.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(rows)
    )
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )


def small(table: DataFrame) -> DataFrame:
    """A written table of a few numbers a row, with a broadcast hint if it is short enough."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents that are not among ``dropped`` (doc_id, text_hash), with all their columns.

    A document is told by its id and the hash of its text, so repeated rows share a
    verdict. A short list is broadcast, which leaves the texts where they are.
    """
    named = dropped.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    gone = small(materialize(named.distinct(), "dropped"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(gone, same, "left_anti")


def codes(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX_2
    return x ^ (x >> np.uint64(31))


def word_bounds(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of word characters and the positions where words start.

    Words are runs of anything but space and U+0009 to U+000D.
    """
    inside = (points != 32) & ((points < 9) | (points > 13))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    return inside, np.flatnonzero(first)


def word_hashes(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: the sum of mixed (character, place in the word) pairs."""
    if not len(points):
        return np.empty(0, np.uint64)
    inside, starts = word_bounds(points)
    if not len(starts):
        return np.empty(0, np.uint64)
    place = np.arange(len(points), dtype=np.int64)
    origin = np.zeros(len(points), np.int64)
    origin[starts] = starts
    place -= np.maximum.accumulate(origin)
    pairs = points.astype(np.uint64)
    pairs <<= np.uint64(32)
    pairs += place.astype(np.uint64)
    pairs += _GOLDEN
    pairs *= _MIX_1
    pairs ^= pairs >> np.uint64(31)
    pairs *= _MIX_2
    pairs[~inside] = 0
    return mix(np.add.reduceat(pairs, starts))


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles of a text, A-Z lower-cased.

    A text of fewer words has its whole sequence as the one shingle; a text
    without words has none.
    """
    points = codes(text)
    upper = (points >= 65) & (points <= 90)
    words = word_hashes(points + (upper * np.uint32(32)).astype(np.uint32))
    count = len(words)
    if not count:
        return words
    size = min(count, width)
    places = np.arange(size + 1, dtype=np.uint64) * _GOLDEN
    total = np.full(count - size + 1, places[size], np.uint64)
    for j in range(size):
        total = total + mix(words[j : count - size + 1 + j] + places[j])
    return np.unique(mix(total))


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable over the edges (a, b).

    Labels spread to neighbours and then jump to the label of their label, so the
    rounds grow with the logarithm of the longest path. Only nodes with edges
    return. Each round is written; the driver sees one count a round.
    """
    both = materialize(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(),
        f"{label}-edges",
    )
    state = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")),
        f"{label}-0",
    )
    for step in range(1, 100):
        near = (
            both.join(state, both.b == state.node)
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        spread = state.join(near, state.node == near.a, "left").select(
            "node",
            F.col("component").alias("before"),
            F.least("component", F.coalesce("near", "component")).alias("component"),
        )
        target = state.select(F.col("node").alias("t"), F.col("component").alias("jump"))
        after = materialize(
            spread.join(target, spread.component == target.t, "left").select(
                "node", "before", F.least("component", F.coalesce("jump", "component")).alias("component")
            ),
            f"{label}-{step}",
        )
        state = after.select("node", "component")
        if after.where("component < before").isEmpty():
            return state
    raise RuntimeError("components did not settle")
