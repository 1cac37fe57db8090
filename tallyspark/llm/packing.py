"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Documents become token pieces of at most ``CAPACITY`` tokens; a full piece is a sequence
of its own. The others are dealt evenly into blocks of about ``BLOCK`` pieces. Each block
is evolved on several islands. Crossover injects whole well-filled sequences of one parent
into the other, drops the sequences that hold an injected piece twice, breaks up some of
the poorest, lets displaced pieces take the place of smaller ones where that fills a
sequence better, and best-fits what is left; the islands of a block exchange their elites between epochs. Sequences
that stay poorly filled are broken up and their pieces dealt into fewer blocks, until one
block or ``ROUNDS`` rounds are left. Every piece is placed exactly once.

Defined results: null text counts as empty; an empty text is one piece, the end id alone.
Very long texts are tokenized whole and cut into pieces. An empty table gives an empty one.
Repeated rows, also of one doc_id, are packed each for itself. Null ids pass through.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import CACHED_CHARS, Memo, forget, keep, release, small_batches
from tallyspark.session import materialize

TOKENIZER = "word_bpe_49k.json"
END_ID = 0
CAPACITY = 2048
BLOCK = 8192
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
GENERATIONS = 40
# An island rests after so many generations without fewer sequences.
PATIENCE = 4
ROUNDS = 4
SETTLED_LOAD = 0.995
INJECTED_SHARE = 0.3
# Sequences broken up by a crossover: at least one and up to this share of those not injected.
BROKEN_SHARE = 0.05
CACHE = 300_000

# Latin-1 letters lower-case one by one and are unchanged by composition; line ends
# separate words like spaces.
_LOWER = bytes(
    32 if c == 10 else c + 32 if 65 <= c <= 90 or (192 <= c <= 222 and c != 215) else c for c in range(256)
)
_TAIL = ".,;:!?|%*&$#()\"-"


# Stands for the end of a word among bytes; words of letters never hold it.
_WORD_END = "\0"


def _byte_names() -> dict[str, int]:
    """The character that names each byte in a byte-level vocabulary.

    Printable bytes name themselves; the others take the characters from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def _letter_encoding(tokenizer_file: str):
    """The same merges over bytes, for words of lower-case letters, several times as fast.

    Valid where entries are numbered in the order of their merges and word ends come
    first, which is checked here; the ids are the tokenizer's own.
    """
    import json

    import tiktoken

    with open(tokenizer_file, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocabulary, suffix = model["vocab"], model["end_of_word_suffix"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocabulary[a + b] for a, b in merges]
    names = _byte_names()
    ranks, closing = {}, []
    for token, i in vocabulary.items():
        whole = token.removesuffix(suffix)
        if whole and all(c in names for c in whole) and not token.startswith("<|"):
            closes = whole != token
            ranks[bytes([names[c] for c in whole]) + (_WORD_END.encode() if closes else b"")] = i
            closing += [i] if closes else []
    single = [i for token, i in vocabulary.items() if len(token.removesuffix(suffix)) == 1]
    if made != sorted(made) or len(single) != 512 or max(single) > made[0]:
        raise ValueError("the vocabulary is not numbered in the order of its merges")
    encoding = tiktoken.Encoding("words", pat_str="[^\0]*\0", mergeable_ranks=ranks, special_tokens={})
    encoding.closes = np.zeros(max(vocabulary.values()) + 1, bool)
    encoding.closes[closing] = True
    return encoding


class WordEncoder:
    """Ids of texts by the tokenizer, remembered by the words between spaces.

    The tokenizer never joins characters across white space, nor letters with the marks
    behind them, so the ids of a text are those of its parts in order. Texts outside
    Latin-1 or with the opening of a special token go to the tokenizer whole.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.letters = _letter_encoding(tokenizer_file)
        self.words = Memo(None, CACHE)
        self.marks = Memo(self._ids, 10_000)
        self.end = np.array([END_ID], "<u4").tobytes()

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encoded(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct words: those of letters and marks behind them in one call, then the others."""
        if not words:
            return {}
        texts = b" ".join(words).decode("latin-1").split(" ")
        stems = [text.rstrip(_TAIL) for text in texts]
        unique = list(dict.fromkeys([stem for stem in stems if stem.isalpha()]))
        ids = np.array(self.letters.encode_ordinary("".join([s + _WORD_END for s in unique])), "<u4")
        ends = (np.flatnonzero(self.letters.closes[ids]) * 4 + 4).tolist()
        data = ids.tobytes()
        known = {s: data[a:b] for s, a, b in zip(unique, [0, *ends], ends, strict=False)}
        marks = self.marks
        found = {
            word: known[stem] + marks[text[len(stem) :]] if len(stem) < len(text) else known[stem]
            for word, text, stem in zip(words, texts, stems, strict=True)
            if stem in known
        }
        if len(found) < len(words):
            found |= {word: self._ids(text) for word, text in zip(words, texts, strict=True) if word not in found}
        return found

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with the end id, as little-endian 32-bit numbers."""
        out: list[bytes] = []
        waiting: list[tuple[int, list, list[int], list[bytes]]] = []
        unseen: set[bytes] = set()
        get, end = self.words.get, self.end
        for text in texts:
            try:
                plain = None if "<|" in text else text.encode("latin-1")
            except UnicodeEncodeError:
                plain = None
            if plain is None:
                out.append(self._ids(text) + end)
                continue
            words = plain.translate(_LOWER).split(b" ")
            found = list(map(get, words))
            if None in found:
                missing = [k for k, ids in enumerate(found) if ids is None]
                new = [words[k] for k in missing]
                waiting.append((len(out), found, missing, new))
                unseen.update(new)
                out.append(b"")
            else:
                out.append(b"".join(found) + end)
        known = self.words.recalled(unseen)
        known |= self._encoded(list(unseen.difference(known)))
        self.words.add({word: ids for word, ids in known.items() if len(word) <= CACHED_CHARS})
        for at, found, missing, new in waiting:
            for k, word in zip(missing, new, strict=True):
                found[k] = known[word]
            out[at] = b"".join(found) + end
        return out


def encoder(name: str = TOKENIZER) -> WordEncoder:
    """The encoder of a public tokenizer, once a process until another operator's tasks run there."""
    import public_tokenizers

    return keep(("word encoder", name), lambda: WordEncoder(public_tokenizers.path(name)))


def pieces_of(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        width = 4 * capacity
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = [
                (doc_id, at // width, at // 4, min(width, len(data) - at) // 4, zlib.crc32(data[at : at + width]))
                for doc_id, data in zip(ids, own.encode_all(batch.column(1).to_pylist()), strict=True)
                for at in range(0, len(data), width)
            ]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )
        release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


# --- one island ---------------------------------------------------------------------


def best_fit(bins: list[list[int]], items: list[int], sizes: list[int], capacity: int) -> None:
    """Put each item, in the given order, into the fullest bin that still takes it."""
    rooms: dict[int, list[int]] = {}
    mask = 0
    for k, members in enumerate(bins):
        room = capacity - sum([sizes[i] for i in members])
        rooms.setdefault(room, []).append(k)
        mask |= 1 << room
    for item in items:
        size = sizes[item]
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            k = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            room, k = capacity, len(bins)
            bins.append([])
        bins[k].append(item)
        room -= size
        rooms.setdefault(room, []).append(k)
        mask |= 1 << room


def fitness(bins: list[list[int]], sizes: list[int]) -> tuple[int, int]:
    """Fewer bins first, then the larger sum of squared loads."""
    return len(bins), -sum([sum([sizes[i] for i in members]) ** 2 for members in bins])


def floor_of(sizes: list[int], capacity: int) -> int:
    """No packing has fewer bins: by the sum of sizes, and by the pieces that cannot share one."""
    return max(-(-sum(sizes) // capacity), sum([2 * size > capacity for size in sizes]))


def replace_smaller(bins: list[list[int]], free: list[int], sizes: list[int], capacity: int) -> list[int]:
    """Put free pieces in place of smaller ones where a bin gets fuller; return the pieces then free.

    Each bin takes the exchange that fills it best, if there is one.
    """
    free = sorted(free, key=sizes.__getitem__)
    keys = [sizes[i] for i in free]
    for members in bins:
        room = capacity - sum([sizes[i] for i in members])
        gain, at, place = 0, -1, -1
        for k, member in enumerate(members if room else ()):
            j = bisect_right(keys, sizes[member] + room) - 1
            if j >= 0 and keys[j] - sizes[member] > gain:
                gain, at, place = keys[j] - sizes[member], k, j
        if gain:
            del keys[place]
            members[at], old = free.pop(place), members[at]
            place = bisect_right(keys, sizes[old])
            keys.insert(place, sizes[old])
            free.insert(place, old)
    return free


def crossover(
    into: list[list[int]], giver: list[list[int]], sizes: list[int], capacity: int, rng: random.Random
) -> list[list[int]]:
    """Inject well-filled bins of ``giver``, remove what they hold twice, best-fit the displaced."""
    loads = [sum([sizes[i] for i in members]) for members in giver]
    good = sorted(range(len(giver)), key=loads.__getitem__, reverse=True)[: max(1, len(giver) // 2)]
    injected = rng.sample(good, max(1, int(len(good) * INJECTED_SHARE)))
    taken = {i for k in injected for i in giver[k]}
    displaced: list[int] = []
    whole: list[list[int]] = []
    for members in into:
        if taken.isdisjoint(members):
            whole.append(list(members))
        else:
            displaced += [i for i in members if i not in taken]
    whole.sort(key=lambda members: sum([sizes[i] for i in members]))
    broken = 1 + int(len(whole) * BROKEN_SHARE * rng.random())
    displaced += [i for members in whole[:broken] for i in members]
    child = [list(giver[k]) for k in injected] + whole[broken:]
    displaced = replace_smaller(child, displaced, sizes, capacity)
    best_fit(child, displaced[::-1], sizes, capacity)
    return [members for members in child if members]


def evolve(
    sizes: list[int], elites: list[list[list[int]]], seed: int, capacity: int = CAPACITY
) -> list[list[int]]:
    """The best solution of an island after its generations, never worse than its elites."""
    rng = random.Random(seed)
    floor = floor_of(sizes, capacity)
    order = sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True)
    people = list(elites)
    while len(people) < POPULATION and all(len(bins) > floor for bins in people):
        bins: list[list[int]] = []
        noise = 0.0 if not people else 0.02
        best_fit(
            bins,
            sorted(order, key=lambda i: -sizes[i] * (1 + noise * rng.random())),
            sizes,
            capacity,
        )
        people.append(bins)
    ranked = sorted(((fitness(p, sizes), k, p) for k, p in enumerate(people)))[:POPULATION]
    fewest, since = ranked[0][0][0], 0
    for step in range(GENERATIONS):
        if ranked[0][0][0] < fewest:
            fewest, since = ranked[0][0][0], step
        if fewest <= floor or step - since >= PATIENCE:
            break
        first, second = rng.sample(range(len(ranked)), 2) if len(ranked) > 1 else (0, 0)
        child = crossover(ranked[first][2], ranked[second][2], sizes, capacity, rng)
        score = fitness(child, sizes)
        if all(score != known for known, _, _ in ranked):
            ranked = sorted([*ranked, (score, POPULATION + step, child)])[:POPULATION]
    return ranked[0][2]


# --- islands on Spark ----------------------------------------------------------------

_PAYLOAD = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
_STATE = pa.schema(
    [
        ("block", pa.int64()),
        ("island", pa.int32()),
        *[(f"{name}s", pa.list_(kind)) for name, kind in _PAYLOAD],
        ("bins", pa.list_(pa.int32())),
        ("n_bins", pa.int64()),
    ]
)
_STATE_DDL = (
    "block long, island int, doc_ids array<long>, pieces array<int>, starts array<long>, "
    "lengths array<long>, ids_crc32s array<long>, bins array<int>, n_bins long"
)


def _as_groups(bins: list[int]) -> list[list[int]]:
    groups: list[list[int]] = [[] for _ in range(max(bins, default=-1) + 1)]
    for item, k in enumerate(bins):
        groups[k].append(item)
    return groups


def _as_numbers(groups: list[list[int]], count: int) -> list[int]:
    bins = [0] * count
    for k, members in enumerate(groups):
        for item in members:
            bins[item] = k
    return bins


def _islands(rows: DataFrame, capacity: int) -> DataFrame:
    """First epoch: one row per block and island with its pieces and its best solution."""

    def found(table: pa.Table) -> pa.Table:
        forget()
        names = [name for name, _ in _PAYLOAD]
        table = table.sort_by([(name, "ascending") for name in names])
        columns = {name: table.column(name).to_pylist() for name in names}
        block, island = table.column("block")[0].as_py(), table.column("island")[0].as_py()
        sizes = columns["length"]
        groups = evolve(sizes, [], block * ISLANDS + island, capacity)
        row = {f"{name}s": values for name, values in columns.items()}
        row |= {"block": block, "island": island, "n_bins": len(groups)}
        done = pa.Table.from_pylist([row | {"bins": _as_numbers(groups, len(sizes))}], _STATE)
        release()
        return done

    spread = rows.withColumn("island", F.explode(F.array(*[F.lit(k) for k in range(ISLANDS)])))
    return spread.groupBy("block", "island").applyInArrow(found, _STATE_DDL)


def _migrated(state: DataFrame, epoch: int, capacity: int) -> DataFrame:
    """Next epoch: each island goes on with its own elite and that of its neighbour."""
    guests = state.select(
        "block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("bins").alias("guest")
    )

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for row in batch.to_pylist():
                elites = [_as_groups(row["bins"]), _as_groups(row.pop("guest"))]
                seed = (row["block"] * ISLANDS + row["island"]) * EPOCHS + epoch
                groups = evolve(row["lengths"], elites, seed, capacity)
                row["bins"], row["n_bins"] = _as_numbers(groups, len(row["lengths"])), len(groups)
                yield pa.RecordBatch.from_pylist([row], _STATE)
        release()

    return state.join(guests, ["block", "island"]).mapInArrow(go_on, _STATE_DDL)


def _placed(best: DataFrame, base: int, least: float) -> DataFrame:
    """Pieces of the best solutions with sequence, offset and whether they stay there."""
    schema = pa.schema([*_PAYLOAD, ("sequence_id", pa.int64()), ("offset", pa.int64()), ("settled", pa.bool_())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                loads = [0] * row["n_bins"]
                offsets = []
                for k, length in zip(row["bins"], row["lengths"], strict=True):
                    offsets.append(loads[k])
                    loads[k] += length
                columns = [row[f"{name}s"] for name, _ in _PAYLOAD]
                columns += [[base + (row["block"] << 20) + k for k in row["bins"]], offsets]
                columns.append([loads[k] >= least for k in row["bins"]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                )
        release()

    return best.mapInArrow(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, "
        "settled boolean",
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Place written pieces: adds sequence_id and offset."""
    names = [name for name, _ in _PAYLOAD]
    row_id = F.monotonically_increasing_id()
    done = [
        pieces.where(F.col("length") == capacity).select(
            *names, (F.lit(1 << 62) + row_id).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
        )
    ]
    open_pieces = pieces.where(F.col("length") < capacity).select(*names)
    for round_ in range(ROUNDS):
        count = open_pieces.count()
        if not count:
            break
        blocks = -(-count // BLOCK)
        last = blocks == 1 or round_ == ROUNDS - 1
        state = materialize(_islands(open_pieces.withColumn("block", row_id % blocks), capacity), "islands")
        for epoch in range(1, EPOCHS):
            state = materialize(_migrated(state, epoch, capacity), "islands")
        whole = F.struct(*[c for c in state.columns if c not in ("block", "island")])
        best = (
            state.groupBy("block")
            .agg(F.min_by(whole, F.struct("n_bins", "island")).alias("best"))
            .select("block", "best.*")
        )
        least = 0 if last else SETTLED_LOAD * capacity
        placed = materialize(_placed(best, round_ << 56, least), "placed")
        done.append(placed.where("settled").select(*names, "sequence_id", "offset"))
        if last:
            break
        open_pieces = placed.where("NOT settled").select(*names)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize and pack whole documents; one row per piece."""
    return pack(materialize(pieces_of(docs, tokenizer, capacity), "pieces"), capacity)
