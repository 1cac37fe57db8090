"""Near-duplicate vectors by NN-descent.

Vectors link when their labels are equal and their cosine reaches a threshold. Exact copies
stand for one vector. A neighbour graph starts from windows over vectors sorted by the
signs of random projections, one order for each of ``ORDERS`` sets of projections. Each
round joins the neighbours of every vector with one another: pairs of neighbours and
reverse neighbours are compared and enter the lists of both. Lists keep the ``NEIGHBOURS``
nearest above ``FLOOR``. An audit compares vectors, one of each component so far, with all
rows, until ``AUDIT_LINKED`` of them have links: the recall is the mean share of a vector's
links that lie inside its component. Every round below ``RECALL`` adds new orders; what the
audit finds is kept. If the last round is below, all vectors are compared across components.

A list that is full of links is saturated and may miss some. Its vector is compared with all
rows of other components, those too far from its component's centre left out, which finds
each component it links with. The links of the joined components are then counted exactly,
block by block, without emitting pairs.

Defined results: vectors that are null, zero, or hold null or non-finite components, and
vectors without label, link with nothing: they are their own component and kept. Copies
link with each other. Rows that repeat a vec_id are one vector each, under the same id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.llm.common import connected_components
from tallyspark.session import materialize, scratch_path

THRESHOLD = 0.93
FLOOR = 0.75
NEIGHBOURS = 16
ORDERS = 8
PROJECTIONS = 32
WINDOW = 192
MAX_ROUNDS = 5
RECALL = 0.98
AUDIT_QUERIES = 400
AUDIT_LINKED = 200
# Vectors sent to all tasks at a time.
CHUNK = 8192
BLOCK = 512

_PAIRS = "a long, b long, cosine double"
_PAIR_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("cosine", pa.float64())])
# (of, hits, n) counts the links of an asked vector; (a, b, cosine) is one that was missed.
_FOUND = "of long, hits long, n long, a long, b long, cosine double"
_FOUND_SCHEMA = pa.schema(
    [("of", pa.int64()), ("hits", pa.int64()), ("n", pa.int64()), *[_PAIR_SCHEMA.field(k) for k in range(3)]]
)


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of a list column, scaled to length one, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _near(a: np.ndarray, b: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cosines = a @ b.T
    x, y = np.nonzero(cosines >= floor)
    return x, y, cosines[x, y]


def _pair_batch(a: np.ndarray, b: np.ndarray, cosines: np.ndarray) -> pa.RecordBatch:
    """Each unordered pair once, smaller number first."""
    keep = a != b
    a, b, cosines = a[keep], b[keep], cosines[keep]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(cosines)], schema=_PAIR_SCHEMA
    )


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """(node, label, embedding, copies, first_id): one row per label and distinct valid vector."""
    valid = (
        F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall(
            "embedding",
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
        )
        & F.exists("embedding", lambda x: x != 0)
    )
    same = (
        vectors.where(F.coalesce(valid, F.lit(False)))
        .groupBy("label", "embedding")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
    )
    return materialize(same.withColumn("node", F.monotonically_increasing_id()), "vectors")


def initial_pairs(nodes: DataFrame, floor: float, orders: int, seed: int = 0) -> DataFrame:
    """Near pairs (a, b, cosine) inside windows over each projection order."""
    spark = nodes.sparkSession
    width = nodes.select(F.max(F.size("embedding"))).first()[0] or 1

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(seed).standard_normal((width, orders * PROJECTIONS))
        weights = (1 << np.arange(PROJECTIONS, dtype=np.int64))[::-1]
        for batch in batches:
            column = batch.column(2)
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                signs = _unit(part.column(2)) @ planes[:size] > 0
                for order in range(orders):
                    code = signs[:, order * PROJECTIONS : (order + 1) * PROJECTIONS] @ weights
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(code), order, np.int32)), part.column(0), pa.array(code), part.column(1), part.column(2)],
                        ["order", "label", "code", "node", "embedding"],
                    )

    label = dict(nodes.dtypes)["label"]
    vector = dict(nodes.dtypes)["embedding"]
    coded = nodes.select("label", "node", "embedding").mapInArrow(
        keys, f"order int, label {label}, code long, node long, embedding {vector}"
    )
    by = ["order", "label", "code", "node"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = coded.repartitionByRange(parts, *by).sortWithinPartitions(*by)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row against the ``WINDOW`` rows before it of the same order, label and width."""
        held: tuple | None = None
        for batch in batches:
            size = batch.column(4).value_lengths().to_numpy(zero_copy_only=False)
            order = batch.column(0).to_numpy(zero_copy_only=False)
            names = batch.column(1).to_numpy(zero_copy_only=False)
            change = np.ones(batch.num_rows, bool)
            change[1:] = (order[1:] != order[:-1]) | (names[1:] != names[:-1]) | (size[1:] != size[:-1])
            starts = [*np.flatnonzero(change).tolist(), batch.num_rows]
            for begin, end in zip(starts, starts[1:], strict=False):
                key = (order[begin], names[begin], size[begin])
                for at in range(begin, end, WINDOW):
                    part = batch.slice(at, min(WINDOW, end - at))
                    own, unit = part.column(3).to_numpy(), _unit(part.column(4))
                    x, y, c = _near(unit, unit, floor)
                    once = x < y
                    yield _pair_batch(own[x[once]], own[y[once]], c[once])
                    if held is not None and held[0] == key:
                        x, y, c = _near(unit, held[2], floor)
                        yield _pair_batch(own[x], held[1][y], c)
                    held = (key, own, unit)

    found = dealt.select("order", "label", "code", "node", "embedding").mapInArrow(windows, _PAIRS)
    return found.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))


def neighbour_lists(pairs: DataFrame, size: int) -> DataFrame:
    """(a, b, cosine): the ``size`` nearest neighbours b of each a."""
    both = pairs.select("a", "b", "cosine").unionAll(
        pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine")
    )
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cosine"), "b"))
    return both.withColumn("rank", rank).where(F.col("rank") <= size).drop("rank")


def descend(nodes: DataFrame, pairs: DataFrame, floor: float, size: int) -> DataFrame:
    """One round: compare the neighbours and reverse neighbours of each vector with one another.

    Forward and reverse lists are cut to the ``size`` nearest, as the method does; the
    pairs known before stay.
    """
    lists = neighbour_lists(pairs, size)
    back = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("cosine"), "a"))
    reverse = lists.withColumn("rank", back).where(F.col("rank") <= size)
    members = (
        lists.select(F.col("a").alias("centre"), F.col("b").alias("member"))
        .unionAll(reverse.select(F.col("b").alias("centre"), F.col("a").alias("member")))
        .distinct()
    )
    cells = members.join(nodes.select(F.col("node").alias("member"), "embedding"), "member")

    def join_cell(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sizes = table.column("embedding").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        keep = sizes == np.bincount(sizes).argmax()
        table = table.filter(pa.array(keep))
        own = table.column("member").to_numpy()
        unit = _unit(table.column("embedding").combine_chunks())
        x, y, c = _near(unit, unit, floor)
        once = x < y
        return pa.Table.from_batches([_pair_batch(own[x[once]], own[y[once]], c[once])])

    new = cells.select("centre", "member", "embedding").groupBy("centre").applyInArrow(join_cell, _PAIRS)
    return pairs.unionAll(new).groupBy("a", "b").agg(F.max("cosine").alias("cosine"))


def audit(nodes: DataFrame, pairs: DataFrame, threshold: float, queries: int) -> tuple[int, int]:
    """(links found, links there are) of at most ``queries`` vectors, by brute force over all.

    The queries, chosen by a hash of their numbers, are broadcast; their count bounds them.
    """
    spark = nodes.sparkSession
    chosen = nodes.orderBy(F.xxhash64("node"), "node").limit(queries).select("node", "label", "embedding").collect()
    sample: dict = {}
    for row in chosen:
        sample.setdefault((row.label, len(row.embedding)), []).append((row.node, row.embedding))
    ready = {}
    for key, rows in sample.items():
        matrix = np.array([r[1] for r in rows], np.float64)
        ready[key] = (
            np.array([r[0] for r in rows], np.int64),
            matrix / np.linalg.norm(matrix, axis=1, keepdims=True),
        )
    shared = spark.sparkContext.broadcast(ready)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            names = batch.column(1).to_numpy(zero_copy_only=False)
            for key, (ids, unit) in shared.value.items():
                here = (names == key[0]) & (sizes == key[1])
                if here.any():
                    part = batch.filter(pa.array(here))
                    x, y, c = _near(unit, _unit(part.column(2)), threshold)
                    yield _pair_batch(ids[x], part.column(0).to_numpy()[y], c)

    true = nodes.select("node", "label", "embedding").mapInArrow(compare, _PAIRS).select("a", "b").distinct()
    known = pairs.where(F.col("cosine") >= threshold).select("a", "b", F.lit(1).alias("hit"))
    row = true.join(known, ["a", "b"], "left").agg(F.count("hit").alias("hits"), F.count("*").alias("n")).first()
    return row.hits, row.n


def orders_for(rows: int, threshold: float) -> int:
    """Orders after which two vectors at the threshold among ``rows`` shared a window with chance ``RECALL``.

    They share one if the signs that cut the rows down to a window are equal, each with
    chance 1 - angle / pi.
    """
    signs = max(0.0, math.log2(max(rows, 1) / WINDOW))
    share = (1 - math.acos(threshold) / math.pi) ** signs
    return max(ORDERS, math.ceil(math.log(1 - RECALL) / math.log1p(-share)) if share < 1 else 1)


def with_components(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """(node, label, component, embedding) of all vectors; one without links is its own component."""
    joined = nodes.join(members, "node", "left")
    return joined.select("node", "label", F.coalesce("component", "node").alias("component"), "embedding")


def against_all(rows: DataFrame, asked: pa.Table, compare: Callable, path: str) -> None:
    """Append to ``path`` what ``compare`` finds of the asked vectors in each batch of ``rows``.

    Both are (node, label, component, embedding). The asked ones are broadcast; their
    caller bounds them. Only rows of the same label and width meet.
    """
    column = asked.column("embedding").combine_chunks()
    widths = column.value_lengths().to_numpy(zero_copy_only=False)
    names = asked.column("label").to_numpy()
    groups: dict = {}
    for at, key in enumerate(zip(names.tolist(), widths.tolist(), strict=True)):
        groups.setdefault(key, []).append(at)
    ready = {
        key: (
            asked.column("node").to_numpy()[at],
            asked.column("component").to_numpy()[at],
            _unit(column.take(pa.array(at))),
        )
        for key, at in groups.items()
    }
    shared = rows.sparkSession.sparkContext.broadcast(ready)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(3).value_lengths().to_numpy(zero_copy_only=False)
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            for key, own in shared.value.items():
                part = batch.filter(pa.array((labels == key[0]) & (sizes == key[1])))
                for at in range(0, part.num_rows, BLOCK):
                    some = part.slice(at, BLOCK)
                    them = (some.column(0).to_numpy(), some.column(2).to_numpy(), _unit(some.column(3)))
                    yield from compare(own, them)

    rows.select("node", "label", "component", "embedding").mapInArrow(run, _FOUND).write.mode("append").parquet(path)
    shared.unpersist()


def _found_batch(of, hits, n, a, b, cosines) -> pa.RecordBatch:
    """Counts of asked vectors, then links that were missed."""
    more, fewer = len(a), len(of)
    zero, void = np.zeros(more, np.int64), pa.nulls(fewer, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([pa.array(of), pa.nulls(more, pa.int64())]),
            pa.array(np.concatenate([hits, zero])),
            pa.array(np.concatenate([n, zero])),
            pa.concat_arrays([void, pa.array(np.minimum(a, b))]),
            pa.concat_arrays([void, pa.array(np.maximum(a, b))]),
            pa.concat_arrays([pa.nulls(fewer, pa.float64()), pa.array(cosines)]),
        ],
        schema=_FOUND_SCHEMA,
    )


def _one_each(a, b, component_a, component_b, cosines):
    """One link for each pair of components."""
    _, first = np.unique(np.stack([component_a, component_b]), axis=1, return_index=True)
    return a[first], b[first], cosines[first]


def count_links(threshold: float) -> Callable:
    """Links of the asked vectors, inside their component and in all."""

    def compare(own: tuple, them: tuple) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(own[0]), BLOCK):
            ids, components, unit = (x[at : at + BLOCK] for x in own)
            x, y, c = _near(unit, them[2], threshold)
            other = ids[x] != them[0][y]
            x, y, c = x[other], y[other], c[other]
            if not len(x):
                continue
            inside = components[x] == them[1][y]
            n = np.bincount(x, minlength=len(ids))
            hits = np.bincount(x[inside], minlength=len(ids))
            seen, out = n > 0, ~inside
            x, y, c = x[out], y[out], c[out]
            missed = _one_each(ids[x], them[0][y], components[x], them[1][y], c)
            yield _found_batch(ids[seen], hits[seen], n[seen], *missed)

    return compare


def cross_links(threshold: float) -> Callable:
    """Links of the asked vectors with other components, exactly, one for each pair of components.

    Asked vectors of one component stand behind their centre: a row whose angle to it is
    more than the angle of the threshold and that of the farthest member links with none.
    """

    def compare(own: tuple, them: tuple) -> Iterator[pa.RecordBatch]:
        ids, components, unit = own
        if id(own) not in balls:
            balls.clear()
            order = np.argsort(components, kind="stable")
            starts = np.flatnonzero(np.diff(components[order], prepend=components[order[0]] - 1))
            centres = np.add.reduceat(unit[order], starts)
            norms = np.linalg.norm(centres, axis=1, keepdims=True)
            centres = np.where(norms > 1e-9, centres / np.maximum(norms, 1e-9), unit[order[starts]])
            sizes = np.diff([*starts, len(order)])
            apart = np.einsum("ij,ij->i", unit[order], np.repeat(centres, sizes, axis=0))
            radius = np.arccos(np.clip(np.minimum.reduceat(apart, starts), -1, 1))
            reach = np.cos(np.minimum(np.pi, radius + math.acos(threshold) + 1e-6)) - 1e-9
            balls[id(own)] = order, starts, sizes, centres, reach
        order, starts, sizes, centres, reach = balls[id(own)]
        for at in range(0, len(starts), BLOCK):
            here = slice(at, at + BLOCK)
            named = components[order[starts[here]]]
            may = (centres[here] @ them[2].T >= reach[here, None]) & (named[:, None] != them[1][None, :])
            for k in np.flatnonzero(may.any(axis=1)).tolist():
                rows = np.flatnonzero(may[k])
                first = starts[at + k]
                for begin in range(first, first + sizes[at + k], BLOCK):
                    members = order[begin : min(begin + BLOCK, first + sizes[at + k])]
                    x, y, c = _near(unit[members], them[2][rows], threshold)
                    if len(x):
                        x, y = members[x], rows[y]
                        missed = _one_each(ids[x], them[0][y], components[x], them[1][y], c)
                        yield _found_batch(*[np.empty(0, np.int64)] * 3, *missed)

    balls: dict = {}
    return compare


def audit_components(rows: DataFrame, threshold: float) -> tuple[float, DataFrame]:
    """(recall, missed links) of one vector of each component, the components weighted alike.

    The vectors, chosen by a hash, are asked in growing steps until ``AUDIT_LINKED`` of them
    have links or all were asked, so rare links are seen too.
    """
    spark = rows.sparkSession
    one = rows.groupBy("component").agg(F.min_by("node", F.struct(F.xxhash64("node"), "node")).alias("node"))
    chosen = materialize(one, "audit-asked")
    parts = max(1, math.ceil(chosen.count() / AUDIT_QUERIES))
    chosen = chosen.withColumn("part", F.pmod(F.xxhash64("component", F.lit(1)), F.lit(parts)))
    path = scratch_path(spark, "audit")
    found = spark.createDataFrame([], _FOUND)
    per_vector = "of IS NOT NULL"
    recall, begin, step = 1.0, 0, 1
    while begin < parts:
        ids = chosen.where(F.col("part").between(begin, begin + step - 1)).select("node")
        asked = rows.join(ids, "node").toArrow()
        begin, step = begin + step, min(2 * max(begin, 1), CHUNK // AUDIT_QUERIES)
        if not asked.num_rows:
            continue
        against_all(rows, asked, count_links(threshold), path)
        found = spark.read.schema(_FOUND).parquet(path)
        each = found.where(per_vector).groupBy("of").agg((F.sum("hits") / F.sum("n")).alias("share"))
        seen = each.agg(F.count("*").alias("linked"), F.avg("share").alias("recall")).first()
        recall = 1.0 if seen.recall is None else seen.recall
        if seen.linked >= AUDIT_LINKED:
            break
    return recall, found.where("a IS NOT NULL").select("a", "b", "cosine")


def saturated(links: DataFrame, size: int) -> DataFrame:
    """(node): vectors whose list of ``size`` neighbours is full of links."""
    ends = links.select(F.col("a").alias("node")).unionAll(links.select(F.col("b").alias("node")))
    return ends.groupBy("node").count().where(F.col("count") >= size).select("node")


def find_cross_links(rows: DataFrame, asked: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b, cosine) of the asked vectors (node) with other components, in chunks."""
    spark = rows.sparkSession
    chosen = materialize(rows.join(asked.select("node").distinct(), "node"), "cross-asked")
    parts = math.ceil(chosen.count() / CHUNK)
    path = scratch_path(spark, "cross")
    for part in range(parts):
        some = chosen.where(F.pmod(F.xxhash64("node"), F.lit(parts)) == part).toArrow()
        if some.num_rows:
            against_all(rows, some.select(rows.columns), cross_links(threshold), path)
    found = spark.read.schema(_FOUND).parquet(path) if parts else spark.createDataFrame([], _FOUND)
    return found.select("a", "b", "cosine")


def exact_links(nodes: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(node, others): copies of other vectors of the same component that link, counted exactly.

    Components are cut into blocks of ``BLOCK`` vectors; a task sees two blocks at a time.
    """
    place = F.row_number().over(Window.partitionBy("component").orderBy("node")) - 1
    rows = (
        members.join(nodes, "node")
        .select("component", "node", "copies", "embedding")
        .withColumn("block", F.floor(place / BLOCK))
    )
    blocks = rows.groupBy("component").agg(F.max("block").alias("last"))
    spread = rows.join(blocks, "component")
    asked = spread.select("*", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("other")).select(
        "component", F.col("block").alias("x"), F.col("other").alias("y"), "node", "copies", "embedding", F.lit(0).alias("side")
    )
    given = spread.select("*", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("other")).select(
        "component", F.col("other").alias("x"), F.col("block").alias("y"), "node", "copies", "embedding", F.lit(1).alias("side")
    )

    def count(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sides = table.column("side").to_numpy()
        parts = [table.filter(pa.array(sides == k)) for k in (0, 1)]
        units = [_unit(p.column("embedding").combine_chunks()) for p in parts]
        ids = [p.column("node").to_numpy() for p in parts]
        hits = (units[0] @ units[1].T >= threshold) & (ids[0][:, None] != ids[1][None, :])
        return pa.table({"node": ids[0], "others": hits @ parts[1].column("copies").to_numpy()})

    return (
        asked.unionAll(given)
        .groupBy("component", "x", "y")
        .applyInArrow(count, "node long, others long")
        .groupBy("node")
        .agg(F.sum("others").alias("others"))
    )


def deduplicate(
    vectors: DataFrame, threshold: float = THRESHOLD, floor: float = FLOOR, size: int = NEIGHBOURS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of (vec_id, embedding, label)."""
    nodes = distinct_vectors(vectors)
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    orders = orders_for(largest, threshold)
    best = F.max("cosine").alias("cosine")
    pairs = materialize(initial_pairs(nodes, floor, orders), "neighbours")
    links = F.col("cosine") >= threshold
    for seed in range(1, MAX_ROUNDS + 1):
        pairs = materialize(descend(nodes, pairs, floor, size), "neighbours")
        members = connected_components(pairs.where(links).select("a", "b"), "vector-components")
        rows = materialize(with_components(nodes, members), "vector-rows")
        recall, missed = audit_components(rows, threshold)
        pairs = pairs.unionAll(missed).groupBy("a", "b").agg(best)
        if recall >= RECALL:
            break
        if seed < MAX_ROUNDS:  # new orders give new starting points
            more = initial_pairs(nodes, floor, orders, seed)
            pairs = pairs.unionAll(more).groupBy("a", "b").agg(best)
    pairs = materialize(pairs, "neighbours")
    # Below the aim after the last round all vectors are compared, else the saturated ones.
    asked = rows if recall < RECALL else saturated(pairs.where(links), size)
    found = find_cross_links(rows, asked, threshold)
    edges = pairs.where(links).select("a", "b").unionAll(found.select("a", "b"))
    members = connected_components(edges, "vector-components")
    counted = exact_links(nodes, members, threshold)
    smallest = (
        members.join(nodes.select("node", "first_id"), "node")
        .groupBy("component")
        .agg(F.min("first_id").alias("component_id"))
    )
    known = (
        nodes.join(members, "node", "left")
        .join(counted, "node", "left")
        .join(smallest, "component", "left")
        .select(
            F.col("label").alias("_label"),
            F.col("embedding").alias("_embedding"),
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "first_id").alias("component_id"),
        )
    )
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    same = (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding"))
    out = rows.join(known, same, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("long").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
