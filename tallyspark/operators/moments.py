"""Exact sums of products of columns: mergeable, without rounding, for any digits.

Integers and decimals are whole numbers of their smallest unit. Each is cut into limbs of 21
bits, so that the products of two limbs, added up over 1,024 rows, stay whole numbers below
2**53: the Gram matrix of such a chunk is exact in doubles, and one matrix product gives the
sums of all pairs of columns. Rows with the same columns missing share a matrix, which makes
every pair complete for itself. A task sends one row per pair; totals are decimals of 18
digits each, which merge by addition, also with those of other loads. Only the few merged
rows meet in whole numbers of any length, from which the statistics are rounded once.

A table without rows gives totals of zero. Columns that are missing everywhere do too.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LIMB_BITS = 21
_LIMB = np.uint64((1 << _LIMB_BITS) - 1)
_CHUNK = 1024
# Matrix sums are kept in two halves, so that neither leaves 64 bits.
_HALF_BITS = 26

_DIGIT_BASE = 10**18
_PARTS = 5
TOTALS = ("sum_x", "sum_y", "sum_xx", "sum_yy", "sum_xy")
_RANGES = ("min_x", "max_x", "min_y", "max_y")

Pair = tuple[str, str]


def is_exact(rows: DataFrame, columns: Iterable[str]) -> bool:
    """Whether all columns are integers or decimals."""
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)
    return all(isinstance(rows.schema[c].dataType, kinds) for c in columns)


def _scale(rows: DataFrame, column: str) -> int:
    return getattr(rows.schema[column].dataType, "scale", 0)


# --- one task -----------------------------------------------------------------------


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Sign, lower and upper 64 bits of the magnitude, and its number of bits at most."""
    if pa.types.is_decimal(column.type):
        raw = np.frombuffer(column.buffers()[1], "<u8")
        raw = raw[2 * column.offset : 2 * (column.offset + len(column))].reshape(-1, 2)
        low, high = raw[:, 0], raw[:, 1]
        bits = math.ceil(column.type.precision * math.log2(10))
    else:
        whole = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        low, high, bits = whole.view(np.uint64), (whole >> 63).view(np.uint64), column.type.bit_width
    negative = high >> np.uint64(63) == 1
    flipped = ~low + np.uint64(1)
    high = np.where(negative, ~high + (flipped == 0).astype(np.uint64), high)
    return np.where(negative, -1.0, 1.0), np.where(negative, flipped, low), high, bits


def limbs(column: pa.Array) -> list[np.ndarray]:
    """Signed limbs of a column as doubles, the lowest first; missing values are 0."""
    sign, low, high, bits = _words(column)
    present = np.asarray(column.is_valid()) * sign
    found = []
    for at in range(0, bits, _LIMB_BITS):
        if at >= 64:
            part = high >> np.uint64(at - 64)
        elif at + _LIMB_BITS > 64:
            part = low >> np.uint64(at) | high << np.uint64(64 - at)
        else:
            part = low >> np.uint64(at)
        found.append((part & _LIMB) * present)
    return found


def gram(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums of the products of columns, as lower and upper halves."""
    chunks = -(-len(matrix) // _CHUNK)
    padded = np.zeros((chunks * _CHUNK, matrix.shape[1]))
    padded[: len(matrix)] = matrix
    stacked = padded.reshape(chunks, _CHUNK, -1)
    sums = np.matmul(stacked.transpose(0, 2, 1), stacked).astype(np.int64)
    return (sums & ((1 << _HALF_BITS) - 1)).sum(axis=0), (sums >> _HALF_BITS).sum(axis=0)


class Totals:
    """What a task has added up: a matrix for each pattern of present columns."""

    def __init__(self, columns: Sequence[str], pairs: Sequence[Pair]):
        self.columns, self.pairs = list(columns), list(pairs)
        self.matrices: dict[int, list[np.ndarray]] = {}
        self.places: dict[str, list[int]] = {}
        self.ranges: dict[Pair, list] = {pair: [None] * 4 for pair in pairs}

    def add(self, batch: pa.RecordBatch) -> None:
        arrays = {c: batch.column(k) for k, c in enumerate(self.columns)}
        parts, at = [np.ones(batch.num_rows)], 1
        pattern = np.zeros(batch.num_rows, np.int64)
        for k, (name, column) in enumerate(arrays.items()):
            own = limbs(column)
            parts += own
            self.places[name] = list(range(at, at + len(own)))
            at += len(own)
            pattern |= np.asarray(column.is_valid()).astype(np.int64) << k
        matrix = np.column_stack(parts)
        for mask in np.unique(pattern).tolist():
            low, high = gram(matrix[pattern == mask])
            held = self.matrices.setdefault(mask, [np.zeros_like(low), np.zeros_like(high)])
            held[0] += low
            held[1] += high
        for x, y in self.pairs:
            ends = [v for c, other in ((x, y), (y, x)) for v in _ends(arrays[c], arrays[other])]
            self.ranges[x, y] = [
                new if old is None else old if new is None else pick(old, new)
                for old, new, pick in zip(self.ranges[x, y], ends, (min, max, min, max), strict=True)
            ]

    def _sum(self, x: list[int], y: list[int], needed: int) -> int:
        """The sum of x times y, numbers given by the places of their limbs."""
        total = 0
        for mask, (low, high) in self.matrices.items():
            if mask & needed == needed:
                for i, a in enumerate(x):
                    for j, b in enumerate(y):
                        total += ((int(high[a, b]) << _HALF_BITS) + int(low[a, b])) << _LIMB_BITS * (i + j)
        return total

    def rows(self) -> Iterator[dict]:
        one = [0]
        for x, y in self.pairs:
            needed = 1 << self.columns.index(x) | 1 << self.columns.index(y)
            px, py = self.places.get(x, []), self.places.get(y, [])
            values = ((px, one), (py, one), (px, px), (py, py), (px, py))
            row = {"x": x, "y": y, "n": self._sum(one, one, needed)}
            for name, (a, b) in zip(TOTALS, values, strict=True):
                row |= dict(zip(_names(name), _digits(self._sum(a, b, needed)), strict=True))
            row |= {k: None if v is None else float(v) for k, v in zip(_RANGES, self.ranges[x, y], strict=True)}
            yield row


def _ends(column: pa.Array, other: pa.Array) -> tuple:
    """Smallest and largest value where the other column is present too."""
    found = pc.min_max(column if not other.null_count else column.filter(other.is_valid()))
    return found["min"].as_py(), found["max"].as_py()


def _names(total: str) -> list[str]:
    return [f"{total}_{k}" for k in range(_PARTS)]


def _digits(number: int) -> list[int]:
    """A whole number in parts of 18 digits, all of its sign, the lowest first."""
    sign, rest, parts = (-1 if number < 0 else 1), abs(number), []
    for _ in range(_PARTS):
        rest, part = divmod(rest, _DIGIT_BASE)
        parts.append(sign * part)
    if rest:
        raise OverflowError(f"a sum of products has more than {18 * _PARTS} digits")
    return parts


# --- rows ---------------------------------------------------------------------------


def _schema() -> T.StructType:
    totals = [name for total in TOTALS for name in _names(total)]
    return T.StructType(
        [
            T.StructField("x", T.StringType()),
            T.StructField("y", T.StringType()),
            T.StructField("n", T.LongType()),
            *[T.StructField(name, T.DecimalType(38, 0)) for name in totals],
            *[T.StructField(name, T.DoubleType()) for name in _RANGES],
        ]
    )


def _arrow(rows: list[dict], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "decimal(38,0)": pa.decimal128(38, 0)}
    fields = [(f.name, kinds[f.dataType.simpleString()]) for f in schema.fields]
    return pa.RecordBatch.from_arrays(
        [pa.array([row[name] for row in rows], kind) for name, kind in fields], [name for name, _ in fields]
    )


def moment_sums(rows: DataFrame, pairs: Sequence[Pair]) -> DataFrame:
    """(x, y, n, sums, ranges): one row per pair and task, over the rows that have both columns."""
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    if not is_exact(rows, columns):
        raise TypeError("exact moments are for integers and decimals")
    schema = _schema()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = Totals(columns, pairs)
        for batch in batches:
            if batch.num_rows:
                totals.add(batch)
        yield _arrow(list(totals.rows()), schema)

    nothing = _arrow(list(Totals(columns, pairs).rows()), schema).to_pylist()
    empty = rows.sparkSession.createDataFrame([tuple(row.values()) for row in nothing], schema)
    return rows.select(*columns).mapInArrow(run, schema).unionByName(empty)


def merged(sums: DataFrame) -> DataFrame:
    """Sums of tasks, or of loads, added up per pair."""
    return sums.groupBy("x", "y").agg(
        F.sum("n").alias("n"),
        *[F.sum(name).cast("decimal(38,0)").alias(name) for total in TOTALS for name in _names(total)],
        *[(F.min if name.startswith("min") else F.max)(name).alias(name) for name in _RANGES],
    )


def _rounded(part: int, whole: int) -> float | None:
    return float(Fraction(part, whole)) if whole else None


def fit_of(n: int, totals: Mapping[str, int], scale_x: int, scale_y: int) -> dict:
    """Least squares of y on x and Pearson's r, each rounded once; None where it is not defined."""
    sx, sy = totals["sum_x"], totals["sum_y"]
    spread_x, spread_y = n * totals["sum_xx"] - sx * sx, n * totals["sum_yy"] - sy * sy
    together = n * totals["sum_xy"] - sx * sy
    unit_x, unit_y = 10**scale_x, 10**scale_y
    squared = _rounded(together * together, spread_x * spread_y)
    return {
        "slope": _rounded(together * unit_x, spread_x * unit_y),
        "intercept": _rounded(sy * spread_x - together * sx, n * spread_x * unit_y),
        "r": None if squared is None else math.copysign(math.sqrt(squared), together),
    }


def pair_fits(rows: DataFrame, fits: Mapping[str, Pair]) -> DataFrame:
    """(fit, x, y, slope, intercept, r, n, min_x, max_x) of each named pair, from one pass."""
    wanted: dict[Pair, list[tuple[str, bool]]] = {}
    for name, (x, y) in fits.items():
        turned = (y, x) in wanted
        wanted.setdefault((y, x) if turned else (x, y), []).append((name, turned))
    scales = {c: _scale(rows, c) for pair in wanted for c in pair}
    schema = T.StructType(
        [T.StructField(name, T.StringType()) for name in ("fit", "x", "y")]
        + [T.StructField(name, T.DoubleType()) for name in ("slope", "intercept", "r")]
        + [T.StructField("n", T.LongType())]
        + [T.StructField(name, T.DoubleType()) for name in ("min_x", "max_x")]
    )
    swapped = {"sum_x": "sum_y", "sum_y": "sum_x", "sum_xx": "sum_yy", "sum_yy": "sum_xx", "sum_xy": "sum_xy"}

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                totals = {
                    total: sum(int(row[name]) * _DIGIT_BASE**k for k, name in enumerate(_names(total)))
                    for total in TOTALS
                }
                for name, turned in wanted[row["x"], row["y"]]:
                    x, y = (row["y"], row["x"]) if turned else (row["x"], row["y"])
                    own = {total: totals[swapped[total] if turned else total] for total in TOTALS}
                    ends = {f"{end}_x": row[f"{end}_{'y' if turned else 'x'}"] for end in ("min", "max")}
                    out.append(
                        {"fit": name, "x": x, "y": y, "n": row["n"], **fit_of(row["n"], own, scales[x], scales[y]), **ends}
                    )
            yield _arrow(out, schema)

    return merged(moment_sums(rows, list(wanted))).mapInArrow(finish, schema)
