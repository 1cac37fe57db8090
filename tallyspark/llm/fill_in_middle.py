"""Fill-in-the-middle: a text cut into prefix, middle and suffix, the middle moved to the end.

Cuts lie between units of a text. Every character has a class (``CLASSES``), and a unit
starts at the characters of certain classes (``UNITS``). The classes of all texts of a batch
form one wavelet matrix. Its ranks add up to the number of units that start before any
place, and bisection on that number finds where a unit starts: all cuts of a batch at once,
in a number of steps that grows with the logarithm of the longest text.

Defined results: a null text counts as empty. Empty texts and texts that hold a marker stay
plain. Very long texts are cut like others; the matrix is built over at most ``CHUNK_CHARS``
characters, or one text. Repeated rows are cut alike, as the cuts hang on the id alone; a
null id is hashed as an empty one. An empty table gives an empty one. Columns other than
doc_id and text are not read, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import codes, release, small_batches

# Markers in front of the parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

SEED = "1"
PLAIN_FROM = 90  # of 100: texts whose third number is not below stay plain
SPM_BELOW = 20  # of 100: of the others, texts whose fourth number is below begin with the suffix

CHUNK_CHARS = 4_000_000

# Classes of characters; the first two tell a letter within a run from one that begins it.
CLASSES = ("letter within", "letter first", "digit", "blank", "line end", "mark", "sentence end", "other")
_LEVELS = 3

# A unit starts at a character of these classes. A word takes along what follows it.
UNITS = {
    "token": tuple(range(1, 8)),
    "word": (1,),
    "char": tuple(range(8)),
}


def _class_table() -> np.ndarray:
    """Class of each ASCII character; a letter counts as one that begins a run."""
    table = np.full(128, CLASSES.index("mark"), np.uint8)
    for chars, name in (
        ("0123456789", "digit"),
        (" \t", "blank"),
        ("\n\r", "line end"),
        (".!?", "sentence end"),
        ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "letter first"),
    ):
        table[[ord(c) for c in chars]] = CLASSES.index(name)
    return table


_TABLE = _class_table()


def classes_of(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of each code point; ``starts`` are the places where texts begin."""
    found = np.full(len(points), CLASSES.index("other"), np.uint8)
    ascii_ = points < 128
    found[ascii_] = _TABLE[points[ascii_]]
    letter = found == 1
    behind = np.zeros(len(points), bool)
    behind[1:] = letter[:-1]
    behind[starts[starts < len(points)]] = False
    found[letter & behind] = 0
    return found


class Bits:
    """A bit vector with the number of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, "<u8")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    def rank(self, ends: np.ndarray) -> np.ndarray:
        """Ones in front of each place."""
        word, bit = ends >> 6, (ends & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)


class WaveletMatrix:
    """Symbols below 2**levels, one bit vector per level from the highest bit on.

    At each level the symbols with a zero bit move to the front, in order, so that the
    symbols of a range stay together and a range is followed down by two ranks a level.
    """

    def __init__(self, symbols: np.ndarray, levels: int = _LEVELS):
        self.levels = levels
        self.bits: list[Bits] = []
        self.zeros: list[int] = []
        for level in reversed(range(levels)):
            one = (symbols >> level) & 1 == 1
            self.bits.append(Bits(one))
            self.zeros.append(len(one) - int(np.count_nonzero(one)))
            symbols = np.concatenate([symbols[~one], symbols[one]])

    def rank(self, symbol: int, ends: np.ndarray) -> np.ndarray:
        """How often a symbol occurs in front of each place."""
        low, high = np.zeros_like(ends), ends
        for k, level in enumerate(reversed(range(self.levels))):
            ones_low, ones_high = self.bits[k].rank(low), self.bits[k].rank(high)
            if symbol >> level & 1:
                low, high = self.zeros[k] + ones_low, self.zeros[k] + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return high - low


class Units:
    """Unit boundaries of a run of texts laid end to end."""

    def __init__(self, texts: list[str], unit: str):
        points = codes("".join(texts))
        lengths = np.array([len(text) for text in texts], np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.matrix = WaveletMatrix(classes_of(points, self.starts))
        chosen = UNITS[unit]
        self.all_but = len(chosen) > len(CLASSES) // 2
        self.symbols = tuple(set(range(len(CLASSES))) - set(chosen)) if self.all_but else chosen
        self.base = self._before(self.starts)
        self.counts = self._before(self.ends) - self.base

    def _before(self, places: np.ndarray) -> np.ndarray:
        """Units that start in front of each place, counted from the first text on."""
        total = np.zeros_like(places)
        for symbol in self.symbols:
            total += self.matrix.rank(symbol, places)
        return places - total if self.all_but else total

    def cut_after(self, units: np.ndarray) -> np.ndarray:
        """Place in each text behind its first ``units`` units: where the next one starts."""
        low, high = self.starts.copy(), self.ends.copy()
        wanted = self.base + units
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            found = self._before(np.minimum(middle + 1, self.ends)) > wanted
            high = np.where(open_ & found, middle, high)
            low = np.where(open_ & ~found, middle + 1, low)
        return np.where(units == 0, 0, low - self.starts)


def numbers_of(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four numbers of 32 bits from the hash of ``seed:id``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(name, 256)
    return [
        F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)
    ]


def _chunks(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of about ``CHUNK_CHARS`` characters; a longer text is a run of its own."""
    first, total = 0, 0
    for k, text in enumerate(texts):
        if k > first and total + len(text) > CHUNK_CHARS:
            yield slice(first, k)
            first, total = k, 0
        total += len(text)
    if first < len(texts):
        yield slice(first, len(texts))


def _holds_marker(text: str) -> bool:
    return "<" in text and any(marker in text for marker in (PREFIX, SUFFIX, MIDDLE))


_FIELDS = [
    ("n", pa.int64()),
    ("form", pa.string()),
    ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()),
    ("output", pa.string()),
]


def _transformed(texts: list[str], numbers: np.ndarray, unit: str, plain_from: int, spm_below: int) -> Iterator[tuple]:
    own = Units(texts, unit)
    first, second = numbers[0] % (own.counts + 1), numbers[1] % (own.counts + 1)
    cuts = zip(
        texts,
        own.counts.tolist(),
        own.cut_after(np.minimum(first, second)).tolist(),
        own.cut_after(np.maximum(first, second)).tolist(),
        (numbers[2] % 100 >= plain_from).tolist(),
        (numbers[3] % 100 < spm_below).tolist(),
        strict=True,
    )
    for text, n, a, b, stays, suffix_first in cuts:
        if not text or stays or _holds_marker(text):
            yield n, "plain", None, None, text
        elif suffix_first:
            yield n, "spm", a, b - a, "".join([SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b]])
        else:
            yield n, "psm", a, b - a, "".join([PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b]])


def transform(
    docs: DataFrame,
    unit: str = "token",
    seed: str = SEED,
    plain_from: int = PLAIN_FROM,
    spm_below: int = SPM_BELOW,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every document."""
    if unit not in UNITS:
        raise ValueError(f"unknown unit {unit!r}")
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            numbers = np.stack([batch.column(2 + k).to_numpy() for k in range(4)])
            for part in _chunks(texts):
                rows = list(_transformed(texts[part], numbers[:, part], unit, plain_from, spm_below))
                columns = [pa.array(c, kind) for c, (_, kind) in zip(zip(*rows, strict=True), _FIELDS, strict=True)]
                ids = batch.column(0).slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", *[name for name, _ in _FIELDS]])
        release()

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        *numbers_of(F.col("doc_id"), seed),
    )
    return rows.mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text behind an output: its parts, told apart by the markers, in their old order."""

    def split(text: Column, marker: str) -> tuple[Column, Column]:
        before = F.substring_index(text, marker, 1)
        return before, F.substr(text, F.length(before) + len(marker) + 1)

    body = F.substr(output, F.lit(len(PREFIX) + 1))
    prefix, rest = split(body, SUFFIX)
    suffix, middle = split(rest, MIDDLE)
    suffix_2, rest_2 = split(body, PREFIX)
    prefix_2, middle_2 = split(rest_2, MIDDLE)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix_2, middle_2, suffix_2))
        .otherwise(output)
    )


def digests(transformed: DataFrame) -> DataFrame:
    """The transformation with hashes instead of texts, and of the texts restored from them."""
    return transformed.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
