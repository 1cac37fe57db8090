"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds sums of ``code * base**place`` modulo a Mersenne prime,
for two bases. It answers whether any two spans are equal in constant time and finds the
longest common extension of two places by binary search.

A fingerprint is the hash of the whole text, its length and, for each of ``BINS`` bins,
the least hash of the ``WINDOW``-character spans that fall into the bin. Equal texts have
equal fingerprints; the share of bins that agree estimates how many spans two texts share.

Defined results: a null text counts as empty. An empty text has no spans: it is like an
empty text (1) and unlike any other (0). A text shorter than the window is one span.
Documents are ordered by (doc_id, text), null ids first; repeated rows follow each other.
A table of one document has itself as the next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import codes, mix, short_reads, small_batches
from tallyspark.session import materialize

PRIME = (1 << 31) - 1
BASES = (1_000_003, 754_974_721)
WINDOW = 8
BINS = 64

_P = np.uint64(PRIME)
_31 = np.uint64(31)


def reduce_mod(x: np.ndarray) -> np.ndarray:
    """Values below 2**63 modulo 2**31 - 1, by folding."""
    x = (x & _P) + (x >> _31)
    x = (x & _P) + (x >> _31)
    return x - _P * (x >= _P).astype(np.uint64)


class _Powers:
    """Powers of a base and of its inverse, grown by doubling."""

    def __init__(self, base: int):
        self.bases = (base, pow(base, -1, PRIME))
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, n: int) -> list[np.ndarray]:
        for k, base in enumerate(self.bases):
            while len(self.tables[k]) < n:
                have = self.tables[k]
                factor = np.uint64(pow(base, len(have), PRIME))
                self.tables[k] = np.concatenate([have, reduce_mod(have * factor)])
        return self.tables


_POWERS = [_Powers(base) for base in BASES]


class Prefixes:
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        points = codes(text).astype(np.uint64) + np.uint64(1)
        self.n = len(points)
        self.sums = []
        for powers in _POWERS:
            terms = reduce_mod(points * powers.upto(self.n + 1)[0][: self.n])
            sums = np.zeros(self.n + 1, np.uint64)
            sums[1:] = reduce_mod(np.cumsum(terms))
            self.sums.append(sums)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """62-bit hashes of the spans [start, end), the same wherever a span stands."""
        parts = []
        for sums, powers in zip(self.sums, _POWERS, strict=True):
            inverse = powers.upto(self.n + 1)[1]
            parts.append(reduce_mod((sums[end] + _P - sums[start]) * inverse[start]))
        return (parts[0] << _31) | parts[1]

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all spans of ``width`` characters, by slices instead of places."""
        count = self.n - width + 1
        parts = []
        for sums, powers in zip(self.sums, _POWERS, strict=True):
            inverse = powers.upto(self.n + 1)[1][:count]
            parts.append(reduce_mod((sums[width:] + _P - sums[:count]) * inverse))
        return (parts[0] << _31) | parts[1]

    def span(self, start: int, end: int) -> int:
        return int(self.spans(np.array([start]), np.array([end]))[0])


def spans_equal(a: Prefixes, i: int, b: Prefixes, j: int, length: int) -> bool:
    """Whether a[i:i+length] and b[j:j+length] are equal."""
    for k, powers in enumerate(_POWERS):
        x = int(a.sums[k][i + length]) - int(a.sums[k][i])
        y = int(b.sums[k][j + length]) - int(b.sums[k][j])
        if i < j:
            x *= int(powers.upto(j - i + 1)[0][j - i])
        elif j < i:
            y *= int(powers.upto(i - j + 1)[0][i - j])
        if (x - y) % PRIME:
            return False
    return True


def longest_common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """Length of the longest common span that starts at i in a and at j in b."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if spans_equal(a, i, b, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def fingerprint(prefixes: Prefixes) -> str:
    """Whole-text hash, length and the least span hash of each bin, in hex."""
    least = np.full(BINS, 0xFFFF, np.uint64)
    if prefixes.n:
        hashes = mix(prefixes.windows(min(WINDOW, prefixes.n)))
        bins = (hashes % np.uint64(BINS)).astype(np.intp)
        full = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(full, bins, hashes >> np.uint64(6))
        used = full != np.iinfo(np.uint64).max
        least[used] = full[used] % np.uint64(0xFFFF)
    whole = prefixes.span(0, prefixes.n) if prefixes.n else 0
    return f"{whole:016x}{prefixes.n:010x}" + least.astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of the used bins in which two fingerprints agree; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    x = np.frombuffer(bytes.fromhex(a[26:]), ">u2")
    y = np.frombuffer(bytes.fromhex(b[26:]), ">u2")
    used = (x != 0xFFFF) | (y != 0xFFFF)
    count = int(used.sum())
    return float(((x == y) & used).sum() / count) if count else 0.0


def edit(text: str, following: str) -> str:
    """The last quarter of a text replaced by as much of the start of the next one."""
    tail = len(text) // 4
    return text[: len(text) - tail] + following[:tail]


class _Entry:
    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text = doc_id, text
        self.prefixes = Prefixes(text)
        self.print = fingerprint(self.prefixes)

    def row(self, following: _Entry) -> dict:
        edited = edit(self.text, following.text)
        prefixes = Prefixes(edited)
        mark = fingerprint(prefixes)
        return {
            "doc_id": self.doc_id,
            "n_chars": len(self.text),
            "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": self.print,
            "edited_fingerprint": mark,
            "near_edited": likeness(self.print, mark),
            "near_next": likeness(self.print, following.print),
            "common_edited": longest_common_extension(self.prefixes, 0, prefixes, 0),
            "common_next": longest_common_extension(self.prefixes, 0, following.prefixes, 0),
        }


_RESULT = [
    ("doc_id", pa.int64()),
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
    ("common_edited", pa.int64()),
    ("common_next", pa.int64()),
]
_EDGE = [("part", pa.int64()), ("role", pa.string()), ("edge_text", pa.string())]
_DDL = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}


def _ddl(fields: list) -> str:
    return ", ".join(f"{name} {_DDL[kind]}" for name, kind in fields)


def _pairs_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition against the next one; its first and last text as edges."""
    schema = pa.schema(_RESULT + _EDGE)
    part, before = TaskContext.get().partitionId(), None
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            entry = _Entry(doc_id, text)
            if before is None:
                rows.append({"part": part, "role": "first", "doc_id": doc_id, "edge_text": text})
            else:
                rows.append({**before.row(entry), "part": part, "role": "done"})
            before = entry
        yield pa.RecordBatch.from_pylist(rows, schema)
    if before is not None:
        last = {"part": part, "role": "last", "doc_id": before.doc_id, "edge_text": before.text}
        yield pa.RecordBatch.from_pylist([last], schema)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(_RESULT)
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(3)]
        rows = [
            _Entry(doc_id, text).row(_Entry(None, following))
            for doc_id, text, following in zip(*columns, strict=True)
        ]
        yield pa.RecordBatch.from_pylist(rows, schema)


def against_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document, its edited text and its likeness to the next document.

    Texts are dealt by ranges of doc_id and sorted once. Inside a partition each row
    meets the next; the last row of a partition meets the first of the next one in a
    join of two rows a partition. The driver sees the numbers of the filled partitions.
    """
    spark = docs.sparkSession
    small_batches(spark)
    short_reads(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    met = materialize(ordered.mapInArrow(_pairs_in_order, _ddl(_RESULT + _EDGE)), "fingerprints")
    names = [name for name, _ in _RESULT]
    filled = sorted(row.part for row in met.where("role = 'first'").select("part").collect())
    done = met.where("role = 'done'").select(*names)
    if not filled:
        return done
    links = spark.createDataFrame(
        list(zip(filled, filled[1:] + filled[:1], strict=True)), "part long, next_part long"
    )
    firsts = met.where("role = 'first'").select(
        F.col("part").alias("next_part"), F.col("edge_text").alias("following")
    )
    edges = (
        met.where("role = 'last'")
        .select("part", "doc_id", "edge_text")
        .join(links, "part")
        .join(firsts, "next_part")
        .select("doc_id", "edge_text", "following")
    )
    return done.unionByName(edges.mapInArrow(_pairs, _ddl(_RESULT)))
