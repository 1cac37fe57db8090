"""Approximate nearest neighbours by inner product: multi-index hashing of learned codes.

Codes. A vector is scaled by the largest norm (vectors of a smaller norm also by a power of
two) and gets one more component that brings its norm to 1, so that nearness by inner
product becomes nearness by angle. Rotations learned by iterative quantization on a sample
of ``SAMPLE`` vectors turn the principal directions into ``BITS`` signs.

Index. All distinct vectors are dealt into blocks. In a block each 16-bit substring of the
codes has a table from its values to rows. Two codes at a distance of at most r differ by
at most r // m in one of the first r % m + 1 of m substrings, or by less in one of the
others. So the rows under all values that near, of all tables, hold every code within the
radius. They are checked in full, and those within it are ranked by their floats in double
precision.

Radius. ``AUDIT`` queries are compared with all vectors. The radius is the distance that
covers ``AIM`` of their true neighbours, in either half of them. Queries that find fewer
neighbours than there are go on with twice the radius. No neighbour list, bucket or
candidate list is cut.

Copies of a vector are searched as one. Only the ``k + 1`` smallest ids of a vector can be
among anyone's nearest; queries that are copies share one search.

Defined results: vectors that are null, empty, zero or hold null or non-finite components,
and rows without id, take no part, nor do vectors of another length than the most frequent
(ties: the shortest). Of several rows of one id the one with the smallest vector counts.
Equal scores are ordered by id. Products beyond the range of doubles are infinite. With
fewer than k candidates all are returned; an empty table gives none. Columns other than
vec_id and embedding are not read, so no name can clash.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import release
from tallyspark.session import materialize

K = 20
BITS = 128
SUBSTRING = 16
SAMPLE = 8192
ITERATIONS = 40
AUDIT = 256
AIM = 0.97
BLOCK = 32_768
CHUNK = 16_384
# Fewer queries than these are not dealt out further for the sake of parallel tasks.
LEAST_CHUNK = 64

# All values of a substring in the order of their number of ones, and how many have at most so many.
_MASKS = np.argsort(np.bitwise_count(np.arange(1 << SUBSTRING)), kind="stable").astype("<u2")
_WITHIN = np.cumsum(np.bincount(np.bitwise_count(np.arange(1 << SUBSTRING))))


# --- codes --------------------------------------------------------------------------


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def for_index(x: np.ndarray, largest: float) -> np.ndarray:
    """Vectors of norm 1: scaled, and filled up in one more component."""
    scaled = x / largest
    halvings = np.clip(np.floor(-np.log2(np.maximum(_norms(scaled), 1e-30))), 0, 60)
    scaled = scaled * np.exp2(halvings)[:, None]
    rest = np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1), 0))
    return np.hstack([scaled, rest[:, None]])


def for_query(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return np.hstack([scaled / _norms(scaled)[:, None], np.zeros((len(x), 1))])


def learn(filled: np.ndarray, bits: int = BITS, iterations: int = ITERATIONS, seed: int = 1) -> np.ndarray:
    """Directions whose signs are the code: principal ones, turned towards the corners of a cube.

    Where there are fewer dimensions than bits, several rotations are learned from
    different starts.
    """
    _, directions = np.linalg.eigh(filled.T @ filled)
    kept = directions[:, ::-1][:, : min(bits, filled.shape[1])]
    inner = filled @ kept
    rng = np.random.default_rng(seed)
    parts: list[np.ndarray] = []
    while sum(part.shape[1] for part in parts) < bits:
        turn, _ = np.linalg.qr(rng.standard_normal((kept.shape[1], kept.shape[1])))
        for _ in range(iterations):
            corners = np.where(inner @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(inner.T @ corners)
            turn = left @ right
        parts.append(kept @ turn)
    return np.hstack(parts)[:, :bits]


def encode(filled: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Codes as rows of bytes."""
    return np.packbits(filled @ directions >= 0, axis=1, bitorder="little")


class MultiIndex:
    """Tables of the substrings of some codes."""

    def __init__(self, codes: np.ndarray):
        self.words = np.ascontiguousarray(codes).view("<u8")
        self.parts = np.ascontiguousarray(codes).view("<u2")
        self.tables = []
        for column in self.parts.T:
            order = np.argsort(column, kind="stable").astype(np.int32)
            values, first, count = np.unique(column[order], return_index=True, return_counts=True)
            place = np.full(1 << SUBSTRING, -1, np.int32)
            place[values] = np.arange(len(values))
            self.tables.append((order, values, first, count, place))

    def candidates(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows that have a substring as near as a code within the radius must have one."""
        m = len(self.tables)
        near, rest = divmod(radius, m)
        found = np.zeros(len(self.words), bool)
        for j, (order, values, first, count, place) in enumerate(self.tables):
            most = min(near if j <= rest else near - 1, SUBSTRING)
            if most < 0:
                continue
            # Either all near values are looked up, or all values present compared.
            if _WITHIN[most] < len(values):
                at = place[_MASKS[: _WITHIN[most]] ^ code[j]]
                at = at[at >= 0]
            else:
                at = np.flatnonzero(np.bitwise_count(values ^ code[j]) <= most)
            sizes = count[at]
            shift = np.repeat(first[at] - (np.cumsum(sizes) - sizes), sizes)
            found[order[shift + np.arange(len(shift))]] = True
        return np.flatnonzero(found)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """The rows of every code within the radius; ``code`` as 16-bit substrings."""
        rows = self.candidates(code, radius)
        distance = np.bitwise_count(self.words[rows] ^ code.view("<u8")).sum(axis=1)
        return rows[distance <= radius]


def best(scores: np.ndarray, rows: np.ndarray, ids: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (scores, ids), ties to smaller ids; ``ids[row]`` has the ids of a scored row."""
    if len(rows) > k:
        good = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, rows = scores[good], rows[good]
    if not len(rows):
        return scores, np.empty(0, np.int64)
    own = [ids[r] for r in rows]
    flat, spread = np.concatenate(own), np.repeat(scores, [len(o) for o in own])
    order = np.lexsort([flat, -spread])[:k]
    return spread[order], flat[order]


# --- rows ---------------------------------------------------------------------------


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding, h): one vector of doubles per id, and its hash."""
    numbers = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("embedding"))
        .where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
        .where(F.exists("embedding", lambda x: x != 0))
    )
    lengths = valid.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    chosen = valid.where(F.size("embedding") == (lengths.d if lengths else 0))
    return (
        chosen.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("h", F.xxhash64("embedding"))
    )


def distinct_vectors(rows: DataFrame, most_ids: int) -> DataFrame:
    """(h, embedding, ids) with the smallest ids of each vector; a hot one sends few rows a task."""
    same = ["h", "embedding"]
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy(*same).orderBy("vec_id")))
    return ranked.where(F.col("r") <= most_ids).groupBy(*same).agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1)


def _sample(rows: DataFrame, by: Column, count: int) -> pa.Table:
    return rows.orderBy(by, "h").limit(count).toArrow()


@dataclass(frozen=True)
class Model:
    """What is learned: directions of the code, the largest norm, and the audited radius."""

    directions: np.ndarray
    largest: float
    radius: int
    recall: float

    def encoded(self, vectors: DataFrame) -> DataFrame:
        """Add the code of each distinct vector."""
        directions, largest = self.directions, self.largest

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    coded = encode(for_index(_matrix(batch.column("embedding")), largest), directions)
                    yield batch.append_column("code", pa.array([row.tobytes() for row in coded], pa.binary()))

        return vectors.mapInArrow(run, "h long, embedding array<double>, ids array<long>, code binary")


def _largest_norm(vectors: DataFrame) -> float:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                top = np.abs(x).max()
                with np.errstate(over="ignore"):
                    yield pa.RecordBatch.from_arrays([pa.array([float(_norms(x / top).max() * top)])], ["norm"])

    found = vectors.select("embedding").mapInArrow(run, "norm double").agg(F.max("norm")).first()[0]
    return min(found, sys.float_info.max) if found is not None else 1.0


def _true_neighbours(
    vectors: DataFrame, queries: np.ndarray, own: np.ndarray, directions: np.ndarray, largest: float, k: int
) -> DataFrame:
    """(query, distance, r) of the k nearest of a few queries among all vectors."""
    asked = encode(for_query(queries), directions).view("<u8")
    own_ids = [int(i) for i in own]

    def compare(x: np.ndarray, ids: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        coded = encode(for_index(x, largest), directions).view("<u8")
        scores = x @ queries.T
        for q in range(len(queries)):
            top = np.argsort(-scores[:, q], kind="stable")[: k + 1]
            distance = np.bitwise_count(coded[top] ^ asked[q]).sum(axis=1)
            entries = [
                (q, int(i), float(scores[r, q]), int(d))
                for r, d in zip(top, distance, strict=True)
                for i in ids[r]
                if i != own_ids[q]
            ]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("query", "vec_id", "score", "distance"), entry, strict=True)) for entry in entries],
                pa.schema([("query", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64()), ("distance", pa.int32())]),
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids = [], []
        for batch in batches:
            if batch.num_rows:
                held.append(_matrix(batch.column(0)))
                ids += batch.column(1).to_pylist()
            if len(ids) >= BLOCK:
                yield from compare(np.vstack(held), ids)
                held, ids = [], []
        if ids:
            yield from compare(np.vstack(held), ids)

    found = vectors.select("embedding", "ids").mapInArrow(run, "query int, vec_id long, score double, distance int")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)


def fit(vectors: DataFrame, queries: DataFrame, k: int = K, bits: int = BITS) -> Model | None:
    """Learn the codes from a sample and the radius from audited queries; None without vectors.

    ``vectors`` and ``queries`` are written tables. The samples, ``SAMPLE`` vectors and
    ``AUDIT`` queries chosen by hashes, are all that passes the driver.
    """
    sample = _sample(vectors.select("h", "embedding"), F.col("h"), SAMPLE)
    if not sample.num_rows:
        return None
    largest = _largest_norm(vectors)
    directions = learn(for_index(_matrix(sample.column("embedding")), largest), bits)
    asked = _sample(queries, F.xxhash64("vec_id"), AUDIT)
    if not asked.num_rows:
        return Model(directions, largest, 0, 1.0)
    truth = _true_neighbours(
        vectors, _matrix(asked.column("embedding")), asked.column("vec_id").to_numpy(), directions, largest, k
    )
    pairs = truth.select("query", "distance").toPandas()
    halves = [pairs.distance[pairs["query"] % 2 == half].to_numpy() for half in (0, 1)]
    radius = max([int(np.quantile(half, AIM, method="higher")) for half in halves if len(half)], default=0)
    recall = min([float((half <= radius).mean()) for half in halves if len(half)], default=1.0)
    return Model(directions, largest, radius, recall)


# --- search -------------------------------------------------------------------------


def _nearest(index: DataFrame, asked: DataFrame, model: Model, radius: int, k: int) -> DataFrame:
    """(q_no, nearest): the k best ids with their scores of each query vector within the radius."""
    spark = index.sparkSession
    n_items, n_asked = index.count(), asked.count()
    blocks = -(-n_items // BLOCK)
    wanted = -(-spark.sparkContext.defaultParallelism // blocks)
    chunks = max(-(-n_asked // CHUNK), min(wanted, -(-n_asked // LEAST_CHUNK)))
    directions = model.directions
    result = pa.schema([("q_no", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(items: pa.Table, queries: pa.Table) -> pa.Table:
        columns: list[list[np.ndarray]] = [[], [], []]
        if items.num_rows and queries.num_rows:
            x, q = _matrix(items.column("embedding")), _matrix(queries.column("embedding"))
            ids = [np.array(own, np.int64) for own in items.column("ids").to_pylist()]
            coded = np.frombuffer(b"".join(items.column("code").to_pylist()), np.uint8).reshape(len(x), -1)
            own_index = MultiIndex(coded)
            for number, vector, code in zip(
                queries.column("q_no").to_pylist(), q, encode(for_query(q), directions).view("<u2"), strict=True
            ):
                rows = own_index.within(code, radius)
                scores, found = best((x[rows] * vector).sum(axis=1), rows, ids, k)
                for column, values in zip(columns, (np.full(len(found), number), found, scores), strict=True):
                    column.append(values)
        release()
        return pa.Table.from_arrays(
            [pa.array(np.concatenate(c) if c else [], f.type) for c, f in zip(columns, result, strict=True)], schema=result
        )

    def dealt(names: list[str], parts: int) -> Column:
        return F.pmod(F.xxhash64(*names), F.lit(parts))

    def each(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))

    items = index.withColumn("block", dealt(["h"], blocks)).withColumn("chunk", each(chunks))
    queries = asked.select("q_no", "embedding").withColumn("chunk", dealt(["q_no"], chunks)).withColumn("block", each(blocks))
    found = (
        items.groupBy("block", "chunk")
        .cogroup(queries.groupBy("block", "chunk"))
        .applyInArrow(search, "q_no long, vec_id long, score double")
    )
    order = Window.partitionBy("q_no").orderBy(F.desc("score"), "vec_id")
    entry = F.struct((-F.col("score")).alias("minus"), "vec_id", "score")
    return (
        found.withColumn("r", F.row_number().over(order))
        .where(F.col("r") <= k)
        .groupBy("q_no")
        .agg(F.sort_array(F.collect_list(entry)).alias("nearest"))
    )


def search(rows: DataFrame, is_query: Column, k: int = K, bits: int = BITS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of the rows that ``is_query`` marks."""
    spark = rows.sparkSession
    base = materialize(usable(rows), "vectors")
    vectors = materialize(distinct_vectors(base, k + 1), "distinct-vectors")
    queries = base.where(is_query)
    model = fit(vectors, queries, k, bits)
    if model is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = materialize(model.encoded(vectors), "index")
    asked = materialize(
        queries.select("h", "embedding").distinct().withColumn("q_no", F.monotonically_increasing_id()), "asked"
    )
    enough = min(k + 1, base.count())
    radius, done, waiting = model.radius, [], asked
    while not waiting.isEmpty():
        found = materialize(_nearest(index, waiting, model, radius, k + 1), "nearest")
        if radius >= bits:
            done.append(found)
            break
        full = found.where(F.size("nearest") >= enough)
        done.append(full)
        waiting = materialize(waiting.join(full.select("q_no"), "q_no", "left_anti"), "waiting")
        radius = min(max(2 * radius, 1), bits)
    if not done:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = done[0]
    for part in done[1:]:
        lists = lists.unionByName(part)
    # Copies that ask share one list; the join on a vector that many rows hold is split by Spark.
    named = queries.select(F.col("vec_id").alias("query_id"), "h", "embedding").join(
        asked.join(lists, "q_no").select("h", "embedding", "nearest"), ["h", "embedding"]
    )
    others = F.slice(F.filter("nearest", lambda entry: entry["vec_id"] != F.col("query_id")), 1, k)
    return named.select("query_id", F.posexplode(others).alias("at", "entry")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "entry.vec_id", "entry.score"
    )
