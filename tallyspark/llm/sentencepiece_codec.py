"""Merge-by-score encoding through a table of last tokens, and its decoding.

For each prefix of a text the encoding has one last token. The table stores it: an
automaton reports the vocabulary entries that end at a place; one of them is the last
token if it is the whole prefix, or if the last token before it is compatible with it,
that is if merging the two tokens' characters gives back the same two tokens. Walking the
table backwards recovers the ids. This takes linear time however long a text is.

No vocabulary entry goes on with a space mark after another character, and characters
outside the vocabulary never merge. Texts are therefore cut there, and the encoding of a
piece is remembered (at most twice ``CACHE`` pieces a process) since words repeat.

Defined results: null text counts as empty; an empty text has only the end id and decodes
to an empty text. Repeated rows are each answered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import Memo, small_batches

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
CACHE = 300_000
# Pair tests that are remembered; when there are as many, only those used again stay.
PAIRS = 200_000


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.end = model.eos_id()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.scores = [model.get_score(i) for i in range(size)]
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or len(self.byte_ids) != 256:
            raise ValueError("the vocabulary has entries across words, or no bytes to fall back to")
        self.letters = {c for p in self.ids for c in p}
        if any(c not in self.ids for c in self.letters):
            raise ValueError("a character of the vocabulary is no entry of its own")
        self.compatible: dict[int, bool] = {}
        self.former_pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.merge(piece) == [i]:  # entries that merging never reaches are no last tokens
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        outside = "[^" + re.escape("".join(sorted(self.letters))) + "]"
        self.parts = re.compile(f"({outside})")
        self.words = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.raw = self._raw_bytes()
        self.after_space = Memo(lambda word: self._entry(SPACE + word), CACHE)
        self.as_is = Memo(self._entry, CACHE)

    def _raw_bytes(self) -> list[bytes]:
        special = {i: bytes([b]) for b, i in self.byte_ids.items()}
        return [
            special[i] if i in special else p.replace(SPACE, " ").encode() if p in self.ids else b""
            for i, p in enumerate(self.pieces)
        ]

    def merge(self, text: str) -> list[int]:
        """The definition: merge the best-scored neighbours, the left one among equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best):
                    best, at = self.scores[i], k
            if at < 0:
                return [self.ids[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, left: int, right: int) -> bool:
        key = left << 20 | right
        known = self.compatible.get(key)
        if known is None:
            known = self.former_pairs.get(key)
            if known is None:
                known = self.merge(self.pieces[left] + self.pieces[right]) == [left, right]
            if len(self.compatible) >= PAIRS:
                self.former_pairs = dict(self.compatible)
                self.compatible.clear()
            self.compatible[key] = known
        return known

    def last_tokens(self, text: str) -> list[int]:
        """Last token of each prefix of a text of vocabulary characters."""
        last = [-1] * (len(text) + 1)
        known = self.compatible
        for end, (token, length) in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            if start == 0:
                last[end] = token
                continue
            before = last[start]
            if before >= 0:
                fits = known.get(before << 20 | token)
                if self._fits(before, token) if fits is None else fits:
                    last[end] = token
        return last

    def _known(self, text: str) -> list[int]:
        last, at, out = self.last_tokens(text), len(text), []
        while at:
            token = last[at]
            if token < 0:
                raise ValueError(f"no last token for a prefix of {text[:40]!r}")
            out.append(token)
            at -= len(self.pieces[token])
        return out[::-1]

    def piece_ids(self, text: str) -> list[int]:
        """Ids of a piece; characters outside the vocabulary become their UTF-8 bytes."""
        if not self.parts.search(text):
            return self._known(text)
        out: list[int] = []
        for k, part in enumerate(self.parts.split(text)):
            if k % 2:
                out += [self.byte_ids[b] for b in part.encode("utf-8", "surrogatepass")]
            elif part:
                out += self._known(part)
        return out

    def _entry(self, piece: str) -> tuple[str, int, bytes]:
        ids = self.piece_ids(piece)
        return " ".join(map(str, ids)), len(ids), b"".join([self.raw[i] for i in ids])

    def _entries(self, text: str) -> list[tuple[str, int, bytes]]:
        """Encoded pieces of a text, in order."""
        if not text:
            return []
        out: list[tuple[str, int, bytes]] = []
        if "  " in text or SPACE in text or text[0] == " " or "\n " in text:
            marked = SPACE + text.replace(" ", SPACE)
            for part in re.split("(\n)", marked):
                if part:
                    out += map(self.as_is.__getitem__, self.words.findall(part) if part != "\n" else ["\n"])
            return out
        first, *lines = text.split("\n")
        out += map(self.after_space.__getitem__, first.split(" "))
        for line in lines:
            out.append(self.as_is["\n"])
            if line:
                word, *words = line.split(" ")
                out.append(self.as_is[word])
                out += map(self.after_space.__getitem__, words)
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text with the end id."""
        return [int(i) for ids, _, _ in self._entries(text) for i in ids.split()] + [self.end]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the space mark put before the text goes, bytes that are no text become U+FFFD."""
        out = b"".join([self.raw[i] for i in ids])
        first = next((i for i in ids if self.raw[i]), None)
        if first is not None and self.pieces[first].startswith(SPACE):
            out = out[1:]
        return out.decode("utf-8", "replace")

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the ids as text, SHA-256 of the decoded text)."""
        entries = self._entries(text)
        ids = " ".join([e[0] for e in entries] + [str(self.end)])
        decoded = b"".join([e[2] for e in entries])
        if entries and entries[0][2].startswith(b" "):
            decoded = decoded[1:]
        return (
            sum([e[1] for e in entries]) + 1,
            hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(decoded).hexdigest(),
        )


@lru_cache(maxsize=2)
def codec(name: str = MODEL) -> Codec:
    """The codec of a public model, once a process."""
    import public_tokenizers

    return Codec(public_tokenizers.path(name))


def digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Encode and decode every text; one row per document."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            found = [own.digest(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.string()),
                    pa.array([f[2] for f in found], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
