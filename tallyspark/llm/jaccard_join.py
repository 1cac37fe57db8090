"""Exact Jaccard self-join of documents on word shingles, as T-occurrence search.

Two documents link when their shingle sets reach a similarity of 80 in 100. A set of n
shingles then shares at least T = ceil(0.8 n) with any partner. The work shrinks in steps,
none of which loses a link between different sets:

1. Documents with equal sets form one class.
2. Filter. Shingles are ordered by hash; of each set only its first n - T + 1 + n // 10
   shingles are counted. Partners share at least T // 10 + 1 of them, so classes with fewer
   shared ones have no partner. Hashes go out as arrays by bucket; what is shared inside a
   task is settled there, so a shingle of a third of all documents costs one entry a task.
3. Leaders. Classes with an equal minimum hash compare with the one among them that shares
   most minima with others, which links most copies in linear work.
4. Search (DivideSkip). Between two components only the documents of the smaller one ask.
   A list counts for a document if it holds a member of a larger component, and a document
   with fewer than T such lists has no partner left. Of its lists the L = T - c longest are
   set aside; a partner is at least c times in the short ones. These are merged by a heap;
   the long ones are answered by binary probes into the candidate's sorted set. Documents
   with a common minimum hash ask together, so that short lists and candidates' sets travel
   once; what is too much for a task is dealt by the hash of the member.

Components are then closed over all links.

Defined results: null text counts as empty; a document without words has no shingles and
links with nothing. Fewer words than the width make one shingle. Repeated rows are of one
class. A null doc_id takes part, but never names a component while another id does.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import (
    connected_components,
    mix,
    release,
    shingles,
    small,
    small_batches,
    without,
)
from tallyspark.session import materialize

WIDTH = 5
PERCENT = 80
SPARE = 10
SIGNATURES = 8
DOCS_PER_BUCKET = 2000
FLUSH = 500_000
LIST_CHUNK = 4096
QUERIES_TOGETHER = 256
ENTRIES_TOGETHER = 500_000
# A candidate is at least T // HITS_SHARE times in the short lists.
HITS_SHARE = 8
HASHES_TOGETHER = 2_000_000

_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_32 = np.uint64(32)


def required(n: int) -> int:
    """Least overlap of a set of n shingles with any partner."""
    return -(-n * PERCENT // 100)


def filter_length(n: int) -> int:
    return min(n, n - required(n) + 1 + n // SPARE)


def required_column(n: Column) -> Column:
    return F.ceil(n * PERCENT / 100).cast("long")


def similar(overlap: Column, n: Column, m: Column) -> Column:
    return overlap * 100 >= (n + m - overlap) * PERCENT


def set_key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


# --- classes and the filter ----------------------------------------------------------

# Rows of the first pass: documents, filter entries, and hits settled inside a task.
_DOCUMENT, _POSTINGS, _SETTLED = 0, 1, 2
_FIRST = "bucket long, kind int, doc_id long, text_hash long, n long, key binary, marks binary, owners binary"
_FIRST_SCHEMA = pa.schema(
    [
        ("bucket", pa.int64()),
        ("kind", pa.int32()),
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("n", pa.int64()),
        ("key", pa.binary()),
        ("marks", pa.binary()),
        ("owners", pa.binary()),
    ]
)
# Rows behind the filter: documents, and hits of classes.
_FILTERED = "kind int, doc_id long, text_hash long, n long, key binary, owner long, hits long"
_FILTERED_SCHEMA = pa.schema(
    [
        ("kind", pa.int32()),
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("n", pa.int64()),
        ("key", pa.binary()),
        ("owner", pa.int64()),
        ("hits", pa.int64()),
    ]
)


def _batch(schema: pa.Schema, rows: int, **columns) -> pa.RecordBatch:
    """A batch of the given columns; the others are null."""
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _owner(key: bytes) -> int:
    """32-bit name of a class in the filter; 0 stands for several classes.

    Classes of one name add up their hits, which only lets more of them pass. Two sets
    that share a shingle would have to agree in it to be taken for one.
    """
    return int.from_bytes(key[:4], "little") or 1


class _Postings:
    """Filter entries of the distinct sets of a task, settled and dealt into buckets."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.seen: set[bytes] = set()
        self.marks: list[np.ndarray] = []
        self.owners: list[np.ndarray] = []
        self.size = 0

    def add(self, key: bytes, hashes: np.ndarray) -> None:
        if key in self.seen:
            return
        self.seen.add(key)
        first = hashes[: filter_length(len(hashes))]
        self.marks.append(first * _SPREAD)
        self.owners.append(np.full(len(first), _owner(key), np.uint32))
        self.size += len(first)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        marks, owners = np.concatenate(self.marks), np.concatenate(self.owners)
        self.clear()
        order = np.argsort(marks, kind="stable")
        marks, owners = marks[order], owners[order]
        first = np.ones(len(marks), bool)
        first[1:] = marks[1:] != marks[:-1]
        group = np.cumsum(first) - 1
        shared = np.bincount(group)[group] > 1
        if shared.any():
            settled, counts = np.unique(owners[shared], return_counts=True)
            yield _batch(
                _FIRST_SCHEMA,
                1,
                bucket=[-1 - int(settled[0]) % self.buckets],
                kind=[_SETTLED],
                marks=[counts.astype(np.uint32).tobytes()],
                owners=[settled.tobytes()],
            )
        owners = np.where(shared, 0, owners)[first].astype(np.uint32)
        marks = marks[first]
        bucket = (marks & np.uint64(0xFFFFFFFF)) % np.uint64(self.buckets)
        order = np.argsort(bucket, kind="stable")
        bucket, owners = bucket[order], owners[order]
        marks = (marks[order] >> _32).astype(np.uint32)
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        starts = np.concatenate([[0], cuts])
        yield _batch(
            _FIRST_SCHEMA,
            len(starts),
            bucket=bucket[starts].astype(np.int64),
            kind=np.full(len(starts), _POSTINGS, np.int32),
            marks=[m.tobytes() for m in np.split(marks, cuts)],
            owners=[o.tobytes() for o in np.split(owners, cuts)],
        )


def first_pass(docs: DataFrame, width: int) -> DataFrame:
    """Documents with set size and key, and the filter's hits, from one pass over the texts.

    What a task sends goes by bucket: filter entries to be compared, documents just to be
    written together with the outcome.
    """
    small_batches(docs.sparkSession)
    buckets = max(64, docs.count() // DOCS_PER_BUCKET)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings = _Postings(buckets)
        for batch in batches:
            sizes, keys = [], []
            for text in batch.column(2).to_pylist():
                hashes = shingles(text, width)
                sizes.append(len(hashes))
                keys.append(set_key(hashes))
                if len(hashes):
                    postings.add(keys[-1], hashes)
                if postings.size >= FLUSH:
                    yield from postings.flush()
            spread = batch.column(1).to_numpy(zero_copy_only=False)
            yield _batch(
                _FIRST_SCHEMA,
                batch.num_rows,
                bucket=-1 - spread % buckets,
                kind=np.full(batch.num_rows, _DOCUMENT, np.int32),
                doc_id=batch.column(0),
                text_hash=batch.column(1),
                n=sizes,
                key=keys,
            )
        yield from postings.flush()
        release()

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("doc_id", "text").alias("spread"),
    )
    sent = rows.mapInArrow(run, _FIRST).groupBy("bucket").applyInArrow(_filtered, _FILTERED)
    return materialize(sent, "shingle-filter")


def _filtered(table: pa.Table) -> pa.Table:
    """What a bucket's entries tell; documents and settled hits are passed on."""
    kinds = table.column("kind").to_numpy()
    parts = []
    documents = table.filter(pa.array(kinds == _DOCUMENT))
    if documents.num_rows:
        columns = {name: documents.column(name).combine_chunks() for name in ("kind", "doc_id", "text_hash", "n", "key")}
        parts.append(_batch(_FILTERED_SCHEMA, documents.num_rows, **columns))
    for kind, read in ((_SETTLED, _settled_hits), (_POSTINGS, _shared_hits)):
        chosen = table.filter(pa.array(kinds == kind))
        if chosen.num_rows:
            marks, owners = (
                np.concatenate([np.frombuffer(b, np.uint32) for b in chosen.column(name).to_pylist()])
                for name in ("marks", "owners")
            )
            found, hits = read(marks, owners)
            parts.append(
                _batch(
                    _FILTERED_SCHEMA,
                    len(found),
                    kind=np.full(len(found), _POSTINGS, np.int32),
                    owner=found.astype(np.int64),
                    hits=hits.astype(np.int64),
                )
            )
    return pa.Table.from_batches(parts, _FILTERED_SCHEMA)


def _settled_hits(counts: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return owners, counts


def _shared_hits(marks: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class, number of its entries that another class has too)."""
    order = np.lexsort((owners, marks))
    marks, owners = marks[order], owners[order]
    first = np.ones(len(marks), bool)
    first[1:] = marks[1:] != marks[:-1]
    starts = np.flatnonzero(first)
    ends = np.concatenate([starts[1:], [len(marks)]]) - 1
    several = (owners[starts] != owners[ends])[np.cumsum(first) - 1]
    once = first.copy()
    once[1:] |= owners[1:] != owners[:-1]
    return np.unique(owners[several & once & (owners != 0)], return_counts=True)


def candidates(first: DataFrame) -> DataFrame:
    """(key, n, first_id): classes that may have a partner."""
    classes = (
        first.where(f"kind = {_DOCUMENT} AND n > 0")
        .groupBy("key")
        .agg(F.first("n").alias("n"), F.min("doc_id").alias("first_id"))
    )
    hits = first.where(f"kind = {_POSTINGS}").groupBy("owner").agg(F.sum("hits").alias("hits"))

    @F.pandas_udf("long")
    def owner(keys):
        return keys.map(lambda key: _owner(bytes(key)))

    needed = F.floor(required_column(F.col("n")) / SPARE) + 1
    return (
        classes.withColumn("owner", owner("key"))
        .join(hits, "owner")
        .where(F.col("hits") >= needed)
        .select("key", "n", "first_id")
    )


# --- sets of the candidates ----------------------------------------------------------


def candidate_sets(docs: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """(node, key, n, first_id, hashes, signs): the whole shingle set of each class."""
    ids = small(chosen.select(F.col("first_id").alias("_id")).distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = mix(np.arange(1, SIGNATURES + 1, dtype=np.uint64))
        for batch in batches:
            found = [h for h in (shingles(text, width) for text in batch.column(0).to_pylist()) if len(h)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_key(h) for h in found], pa.binary()),
                    pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64())),
                    pa.array([[int(mix(h ^ s).min().view(np.int64)) for s in salts] for h in found], pa.list_(pa.int64())),
                ],
                ["key", "hashes", "signs"],
            )
        release()

    sets = (
        texts.mapInArrow(run, "key binary, hashes array<long>, signs array<long>")
        .groupBy("key")
        .agg(F.first("hashes").alias("hashes"), F.first("signs").alias("signs"))
    )
    return materialize(
        sets.join(chosen, "key").withColumn("node", F.monotonically_increasing_id()), "shingle-sets"
    )


# --- leaders ---------------------------------------------------------------------------


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    ends = small(pairs.select(F.col("b").alias("node")).distinct())
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("hashes").alias("h_a"))
    right = sets.join(ends, "node", "left_semi").select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("hashes").alias("h_b"))
    both = left.join(small(pairs), "a").join(right, "b")
    fits = (F.col("n_a") * 100 >= F.col("n_b") * PERCENT) & (F.col("n_b") * 100 >= F.col("n_a") * PERCENT)
    overlap = F.size(F.array_intersect("h_a", "h_b"))
    return both.where(fits).where(similar(overlap, F.col("n_a"), F.col("n_b"))).select("a", "b")


def leader_pairs(sets: DataFrame) -> DataFrame:
    """Each node with the leaders of its signatures.

    The leader of a signature is the node whose signatures are the most common ones:
    in a cloud of edited copies that is the one closest to the others.
    """
    signed = sets.select("node", F.posexplode("signs").alias("k", "sign"))
    common_signs = signed.groupBy("k", "sign").agg(F.count("*").alias("holders")).where("holders > 1")
    held = signed.join(common_signs, ["k", "sign"])
    weight = held.groupBy("node").agg(F.sum("holders").alias("weight"))
    held = held.join(weight, "node")
    leaders = held.groupBy("k", "sign").agg(F.max_by("node", F.struct("weight", "node")).alias("b"))
    return held.join(leaders, ["k", "sign"]).where("node <> b").select(F.col("node").alias("a"), "b").distinct()


def commonest_signature(sets: DataFrame) -> DataFrame:
    """(node, sign): of a node's signatures the one that most nodes have.

    The members of a cloud of edited copies agree in few of these, however much any one
    of their signatures varies.
    """
    signed = sets.select("node", F.posexplode("signs").alias("k", "sign"))
    holders = signed.groupBy("k", "sign").agg(F.count("*").alias("holders"))
    return (
        signed.join(holders, ["k", "sign"])
        .groupBy("node")
        .agg(F.max(F.struct("holders", "k", "sign")).alias("best"))
        .select("node", F.xxhash64("best.k", "best.sign").alias("sign"))
    )


def with_components(sets: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """(node, component) of every node."""
    known = connected_components(links, label)
    return sets.select("node").join(known, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


# --- DivideSkip ------------------------------------------------------------------------


def merge_short_lists(lists: list[np.ndarray], least: int) -> list[tuple[int, int]]:
    """(candidate, hits) of the members found at least ``least`` times, by a heap merge."""
    found: list[tuple[int, int]] = []
    last, hits = None, 0
    for member in heapq.merge(*[entries.tolist() for entries in lists]):
        if member == last:
            hits += 1
            continue
        if last is not None and hits >= least:
            found.append((last, hits))
        last, hits = member, 1
    if last is not None and hits >= least:
        found.append((last, hits))
    return found


def probe(candidates: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Whether each candidate is in a sorted list, by binary search."""
    if not len(members):
        return np.zeros(len(candidates), bool)
    at = np.minimum(np.searchsorted(members, candidates), len(members) - 1)
    return members[at] == candidates


def short_candidates(names: np.ndarray, rank: int, n: int, lists: dict[int, tuple[np.ndarray, ...]]) -> list[int]:
    """Members of larger components that the short lists bring up often enough, the most frequent first.

    ``lists`` maps a shingle to (nodes, ranks, sizes) of its members.
    """
    brought, sizes = [], {}
    for g in names.tolist():
        if g in lists:
            nodes, ranks, counts = lists[g]
            fits = (ranks > rank) & (counts * 100 >= n * PERCENT) & (n * 100 >= counts * PERCENT)
            if fits.any():
                brought.append(nodes[fits])
    found = merge_short_lists(brought, least_hits(n))
    return [member for member, _ in sorted(found, key=lambda f: (-f[1], f[0]))]


def least_hits(n: int) -> int:
    return max(1, required(n) // HITS_SHARE)


def partners(
    names: np.ndarray, n: int, members: list[int], sets: dict[int, tuple[int, int, np.ndarray]]
) -> list[int]:
    """The members similar to an asker, one for each component.

    ``names`` are all the shingles the asker may share with them, ``sets`` maps a member
    to (rank, size, sorted shingles).
    """
    found, joined = [], set()
    for member in members:
        rank, size, hashes = sets[member]
        if rank not in joined:
            overlap = int(probe(names, hashes).sum())
            if overlap * 100 >= (n + size - overlap) * PERCENT:
                joined.add(rank)
                found.append(member)
    return found


def search(sets: DataFrame, components: DataFrame) -> DataFrame:
    """Links (a, b) of each document with every larger component that holds a partner."""
    # Components in order of their size: ranges of sizes are numbered one after another.
    ordered = (
        components.groupBy("component")
        .agg(F.count("*").alias("members"))
        .repartitionByRange("members", "component")
        .sortWithinPartitions("members", "component")
    )
    ranks = materialize(ordered.select("component", F.monotonically_increasing_id().alias("rank")), "search-ranks")
    people = materialize(
        components.join(ranks, "component").join(sets.select("node", "n"), "node").select("node", "rank", "n"),
        "search-people",
    )
    people = small(people)
    tops = (
        sets.select("node", "hashes")
        .join(people.select("node", "rank"), "node")
        .select("rank", F.explode("hashes").alias("g"))
        .groupBy("g")
        .agg(F.max("rank").alias("top"), F.min("rank").alias("low"), F.count("*").alias("df"))
        .where("low < top")
        .drop("low")
    )
    # Lists of the shingles that several components have, in chunks of a size.
    chunk = F.pmod(F.xxhash64("node"), F.ceil(F.col("df") / LIST_CHUNK))
    lists = materialize(
        sets.select("node", F.explode("hashes").alias("g"))
        .join(tops, "g")
        .join(people, "node")
        .groupBy("g", chunk.alias("chunk"))
        .agg(
            F.max("top").alias("top"),
            F.max("df").alias("df"),
            F.collect_list(F.struct("node", "rank", F.col("n").cast("int").alias("n"))).alias("members"),
        )
        .select("g", "top", "df", "members.node", "members.rank", "members.n"),
        "search-lists",
    )
    own = F.explode(F.arrays_zip("node", "rank")).alias("own")
    asked = (
        lists.select("g", "top", "df", own)
        .where("own.rank < top")
        .groupBy(F.col("own.node").alias("node"))
        .agg(F.sort_array(F.collect_list(F.struct("df", "g"))).alias("names"))
        .withColumn("names", F.col("names.g"))
        .join(people, "node")
        .where(F.size("names") >= required_column(F.col("n")))
        .join(commonest_signature(sets), "node")
    )
    asked = materialize(asked, "search-queries")
    # Askers of one signature ask together, as many as a task takes.
    crowd = asked.groupBy("sign").agg(F.ceil(F.count("*") / QUERIES_TOGETHER).alias("crowds"))
    n_short = F.size("names") - required_column(F.col("n")) + F.greatest(
        F.lit(1), F.floor(required_column(F.col("n")) / HITS_SHARE)
    )
    asked = asked.join(crowd, "sign").select(
        F.xxhash64("sign", F.pmod(F.xxhash64("node"), "crowds")).alias("batch"), "node", "n", "rank", "names",
        F.slice("names", F.lit(1), n_short.cast("int")).alias("short"),
    )
    asked = materialize(asked, "search-askers")
    wanted = materialize(asked.select("batch", F.explode("short").alias("g")).distinct(), "search-wanted")
    brought = small(wanted).join(lists.select("g", "node", "rank", "n"), "g")
    parts = (
        brought.groupBy("batch")
        .agg(F.ceil(F.sum(F.size("node")) / ENTRIES_TOGETHER).cast("int").alias("parts"))
        .select("batch", "parts", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
    )
    parts = materialize(parts, "search-parts")
    questions = asked.join(parts, "batch").select(
        "batch", "part", "parts", F.lit(None).cast("long").alias("g"), F.col("short").alias("names"),
        F.array("node").alias("node"), F.array("rank").alias("rank"), F.array(F.col("n").cast("int")).alias("n"),
    )
    answers = brought.join(parts, "batch").select(
        "batch", "part", "parts", "g", F.lit(None).cast("array<long>").alias("names"), "node", "rank", "n"
    )
    proposed = materialize(
        questions.unionByName(answers)
        .groupBy("batch", "part")
        .applyInArrow(_propose, "batch long, part int, node long, members array<long>"),
        "search-candidates",
    )
    # Each candidate's set goes to the askers of a batch once.
    per_part = max(1, HASHES_TOGETHER // 1000)
    union = proposed.where("node IS NULL").select(
        "batch", "part", F.explode("members").alias("node"), F.ceil(F.size("members") / per_part).cast("int").alias("shares")
    )
    share = F.pmod(F.hash("node"), F.col("shares"))
    union = small(materialize(union.select("batch", "part", share.alias("share"), "node"), "search-union"))
    given = (
        sets.select("node", F.sort_array("hashes").alias("names"))
        .join(union, "node")
        .join(people, "node")
        .select("batch", "part", "share", "node", "rank", "n", "names", F.lit(None).cast("array<long>").alias("members"))
    )
    shares = union.select("batch", "part", "share").distinct()
    asking = (
        proposed.where("node IS NOT NULL AND size(members) > 0")
        .join(asked.select("batch", "node", "rank", "n", "names"), ["batch", "node"])
        .join(shares, ["batch", "part"])
        .select("batch", "part", "share", "node", "rank", "n", "names", "members")
    )
    return given.unionByName(asking).groupBy("batch", "part", "share").applyInArrow(_verify, "a long, b long")


def _propose(table: pa.Table) -> pa.Table:
    """For each asker of a batch its candidates, and in a row without asker all of them together."""
    batch, part, parts = (table.column(name)[0].as_py() for name in ("batch", "part", "parts"))
    asks = np.array(table.column("g").is_null())
    held = table.filter(pa.array(~asks))
    pieces: dict[int, list] = {}
    columns = [_rows(held.column(name)) for name in ("node", "rank", "n")]
    for g, nodes, ranks, sizes in zip(held.column("g").to_pylist(), *columns, strict=True):
        if parts > 1:
            here = mix(nodes.astype(np.uint64)) % np.uint64(parts) == part
            nodes, ranks, sizes = nodes[here], ranks[here], sizes[here]
        pieces.setdefault(g, []).append((nodes, ranks, sizes.astype(np.int64)))
    lists = {}
    for g, found in pieces.items():
        nodes, ranks, sizes = (np.concatenate(column) for column in zip(*found, strict=True))
        by_node = np.argsort(nodes)
        lists[g] = (nodes[by_node], ranks[by_node], sizes[by_node])
    askers = table.filter(pa.array(asks))
    nodes: list[int | None] = []
    members: list[list[int]] = []
    for names, node, rank, size in zip(
        *[_rows(askers.column(name)) for name in ("names", "node", "rank", "n")], strict=True
    ):
        nodes.append(int(node[0]))
        members.append(short_candidates(names, int(rank[0]), int(size[0]), lists))
    nodes.append(None)
    members.append(sorted({m for found in members for m in found}))
    release()
    return pa.table(
        {
            "batch": pa.array([batch] * len(nodes), pa.int64()),
            "part": pa.array([part] * len(nodes), pa.int32()),
            "node": pa.array(nodes, pa.int64()),
            "members": pa.array(members, pa.list_(pa.int64())),
        }
    )


def _verify(table: pa.Table) -> pa.Table:
    """The candidates that are similar, for each asker of a batch."""
    asks = np.array(table.column("members").is_valid())
    held = table.filter(pa.array(~asks))
    columns = [held.column(name).to_pylist() for name in ("node", "rank", "n")]
    sets = dict(zip(columns[0], zip(*columns[1:], _rows(held.column("names")), strict=True), strict=True))
    askers = table.filter(pa.array(asks))
    a, b = [], []
    for node, n, names, members in zip(
        askers.column("node").to_pylist(),
        askers.column("n").to_pylist(),
        _rows(askers.column("names")),
        _rows(askers.column("members")),
        strict=True,
    ):
        found = partners(names, n, [m for m in members.tolist() if m in sets], sets)
        a += [node] * len(found)
        b += found
    release()
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _rows(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a list column as numpy views."""
    out = []
    for chunk in column.chunks:
        ends = np.cumsum(chunk.value_lengths().to_numpy(zero_copy_only=False))[:-1]
        out += np.split(chunk.flatten().to_numpy(zero_copy_only=False), ends) if len(chunk) else []
    return out


# --- the join ----------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id) of each row of (doc_id, text)."""
    first = first_pass(docs, width)
    chosen = materialize(candidates(first), "shingle-candidates")
    sets = candidate_sets(docs, chosen, width)
    pairs = materialize(leader_pairs(sets), "shingle-leaders")
    links = materialize(verified(pairs, sets), "shingle-links")
    components = materialize(with_components(sets, links, "shingle-leaders"), "shingle-components")
    links = links.unionAll(materialize(search(sets, components), "shingle-links"))
    components = with_components(sets, links, "shingle-components")
    named = components.join(sets.select("node", "key", "first_id"), "node")
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = named.join(smallest, "component").select("key", "component_id")
    classes = (
        first.where(f"kind = {_DOCUMENT} AND n > 0")
        .groupBy("key")
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    )
    # Most classes are one document that links with nothing: only the others are joined back.
    known = (
        classes.join(linked, "key", "left")
        .where("copies > 1 OR component_id IS NOT NULL")
        .select("key", F.coalesce("component_id", "first_id").alias("component_id"))
    )
    rows = first.where(f"kind = {_DOCUMENT}").select("doc_id", "text_hash", "n", "key")
    return rows.join(known, "key", "left").select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with the smallest doc_id of their group, with all their columns.

    Documents without words and without group all stay; rows that repeat a kept doc_id
    and text are the same document and stay too.
    """
    return without(docs, near_duplicates(docs).where("NOT component_id <=> doc_id"))
