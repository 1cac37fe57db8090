"""Language identification: text likelihoods fused with what else is known of a row.

Text: a multinomial model of character trigrams for each language, learned from labelled
rows, and an ``UNKNOWN`` class that finds every trigram equally likely. Declared markup
language and address suffix: P(declared | language) and P(suffix | language). Host: a prior
of the language, smoothed towards that of its domain (the last two labels of an address) and
that towards the whole corpus; the suffix is not a level of it and so speaks once.
The tables behind the last three come from one grouped aggregation each over all rows,
weighted by the text posteriors, so no label is needed there. The log terms add up.

Defined results: a null or empty text has no likelihood; the other evidence decides alone.
Absent host, suffix or declaration adds nothing. Only a text with letters can be accepted. Ties go to the first language by name.
Repeated rows are each answered; texts of any length are read whole. Without labelled rows every answer is ``UNKNOWN``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import codes, forget, release, small_batches, without
from tallyspark.session import materialize

UNKNOWN = "und"
BUCKET_BITS = 16
SAMPLE_ROWS = 12_000
SMOOTHING = 0.5
# Neighbouring trigrams overlap; their evidence is weighted down accordingly.
TEXT_WEIGHT = 1 / 3
UNKNOWN_PRIOR = 0.001
HOST_STRENGTH = 20.0
DECLARED_STRENGTH = 5.0
MIN_POSTERIOR = 0.5

_BUCKETS = 1 << BUCKET_BITS
_MULTIPLIER = np.uint32(2654435761)


def trigrams(text: str) -> np.ndarray:
    """Bucket of each character trigram; digits and marks count as spaces, spaces as one."""
    points = codes(" " + text.lower() + " ")
    points = np.where((points < 97) | ((points > 122) & (points < 192)), np.uint32(32), points)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    points = points[keep].astype(np.uint32)
    if len(points) < 3:
        return np.empty(0, np.intp)
    key = (points[:-2] * np.uint32(0x10001) + points[1:-1]) * np.uint32(0x9E3779B1) + points[2:]
    return ((key * _MULTIPLIER) >> np.uint32(32 - BUCKET_BITS)).astype(np.intp)


class TextModel:
    """Log likelihoods of trigram buckets, one row for each language and the unknown one."""

    def __init__(self, languages: list[str], weights: np.ndarray):
        self.languages, self.weights = languages, weights

    def scores(self, text: str) -> np.ndarray:
        found = trigrams(text)
        if not len(found):
            return np.zeros(len(self.languages))
        return self.weights[:, found].sum(axis=1) * TEXT_WEIGHT


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> TextModel:
    """Learn from (doc_id, text, lang): the ``sample_rows`` rows of smallest id hash, whole texts.

    The driver receives one count for each language and bucket.
    """
    small_batches(labelled.sparkSession)
    chosen = (
        labelled.where("lang IS NOT NULL AND lang <> ''")
        .select("doc_id", "lang")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "lang")
        .limit(sample_rows)
    )
    rows = labelled.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id").where(
        "text IS NOT NULL AND lang IS NOT NULL AND lang <> ''"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = totals.setdefault(lang, np.zeros(_BUCKETS, np.int64))
                found = trigrams(text)
                if len(found):
                    own += np.bincount(found, minlength=_BUCKETS)
        for lang, own in totals.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(own[used])],
                ["lang", "bucket", "n"],
            )
        release()

    counted = (
        rows.select("lang", "text")
        .mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    languages = sorted({row.lang for row in counted})
    table = np.zeros((len(languages), _BUCKETS))
    for row in counted:
        table[languages.index(row.lang), row.bucket] = row.n
    # The buckets any language uses, and one for all others.
    used = int(table.any(axis=0).sum()) + 1
    weights = np.full((len(languages) + 1, _BUCKETS), -np.log(used))
    weights[:-1] = np.log((table + SMOOTHING) / (table.sum(axis=1, keepdims=True) + SMOOTHING * used))
    return TextModel([*languages, UNKNOWN], weights)


def score_texts(rows: DataFrame, model: TextModel) -> DataFrame:
    """Replace ``text`` by ``text_scores``: the log likelihood of each class; other columns stay."""
    small_batches(rows.sparkSession)
    others = [c for c in rows.columns if c != "text"]
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        own = shared.value
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = [own.scores(text).tolist() if text else [0.0] * len(own.languages) for text in texts]
            columns = [batch.column(i + 1) for i in range(len(others))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.list_(pa.float64()))], [*others, "text_scores"]
            )
        release()

    schema = ", ".join(f"`{c}` {dict(rows.dtypes)[c]}" for c in others) + ", text_scores array<double>"
    return rows.select("text", *others).mapInArrow(score, schema)


def _posterior(logs: Column) -> Column:
    """Softmax of an array of log values."""
    shifted = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    total = F.aggregate(shifted, F.lit(0.0), lambda a, x: a + x)
    return F.transform(shifted, lambda x: x / total)


def _sums(rows: DataFrame, keys: list[str], classes: int, name: str) -> DataFrame:
    """Posterior mass of each class by key, as an array."""
    sums = [F.sum(F.col("posterior")[k]).alias(f"_{k}") for k in range(classes)]
    packed = F.array(*[F.col(f"_{k}") for k in range(classes)])
    return rows.groupBy(*keys).agg(*sums).select(*keys, packed.alias(name))


def _likelihood(rows: DataFrame, column: str, total: list[float], strength: float) -> DataFrame:
    """log P(value | class) for each value of a column, smoothed towards P(value)."""
    sums = _sums(rows.where(F.col(column).isNotNull()), [column], len(total), "mass")
    every = max(sum(total), 1e-9)
    share = F.aggregate(F.col("mass"), F.lit(0.0), lambda a, x: a + x) / F.lit(every)
    totals = F.array(*[F.lit(float(t)) for t in total])
    logs = F.zip_with(
        F.col("mass"), totals, lambda m, t: F.ln((m + strength * share + 1e-9) / (t + strength))
    )
    return sums.select(column, logs.alias(f"{column}_logs"))


def fuse(scored: DataFrame, model: TextModel) -> DataFrame:
    """Add ``lang_found``, ``posterior_found`` and ``text_lang`` to rows from ``score_texts``.

    ``scored`` has host, suffix and declared (null where absent) and is read several
    times; texts are not among its columns. The driver sees one total for each class.
    """
    classes = len(model.languages)
    prior = [(1 - UNKNOWN_PRIOR) / max(classes - 1, 1)] * (classes - 1) + [UNKNOWN_PRIOR]
    flat = F.array(*[F.lit(float(np.log(p))) for p in prior])
    add = lambda a, b: a + b
    rows = scored.withColumn("posterior", _posterior(F.zip_with("text_scores", flat, add)))
    total = list(rows.agg(*[F.coalesce(F.sum(F.col("posterior")[k]), F.lit(0.0)) for k in range(classes)]).first())
    every = sum(total)
    world = F.array(*[F.lit((t + p) / (every + 1)) for t, p in zip(total, prior, strict=True)])

    # Host priors: corpus -> domain -> host.
    domain = F.when(F.col("suffix").isNotNull(), F.substring_index("host", ".", -2))
    rows = rows.withColumn("domain", domain)
    hosts = _sums(rows.where("host IS NOT NULL"), ["domain", "host"], classes, "host_mass")
    domains = _sums(rows.where("host IS NOT NULL"), ["domain"], classes, "domain_mass")

    def smoothed(mass: Column, above: Column) -> Column:
        size = F.aggregate(mass, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(mass, above, lambda m, p: (m + HOST_STRENGTH * p) / (size + HOST_STRENGTH))

    domains = domains.select(
        F.col("domain").alias("_domain"), smoothed(F.col("domain_mass"), world).alias("domain_prior")
    )
    hosts = hosts.join(domains, F.col("domain").eqNullSafe(F.col("_domain"))).select(
        F.col("domain").alias("host_domain"),
        F.col("host").alias("host_name"),
        F.transform(smoothed(F.col("host_mass"), F.col("domain_prior")), lambda x: F.ln(x)).alias("host_logs"),
    )
    out = rows.join(
        hosts, F.col("domain").eqNullSafe(F.col("host_domain")) & (F.col("host") == F.col("host_name")), "left"
    )
    for column in ("suffix", "declared"):
        logs = _likelihood(rows, column, total, DECLARED_STRENGTH)
        out = out.join(logs.withColumnRenamed(column, "_value"), F.col(column) == F.col("_value"), "left").drop(
            "_value"
        )
    nothing = F.array(*[F.lit(0.0)] * classes)
    world_logs = F.transform(world, lambda x: F.ln(x))
    fused = F.zip_with("text_scores", F.coalesce("host_logs", world_logs), add)
    fused = F.zip_with(fused, F.coalesce("suffix_logs", nothing), add)
    fused = F.zip_with(fused, F.coalesce("declared_logs", nothing), add)
    names = F.array(*[F.lit(name) for name in model.languages])
    out = out.withColumn("fused", _posterior(fused))
    best = F.array_max("fused")
    return out.select(
        *scored.columns,
        names[(F.array_position("fused", best) - 1).cast("int")].alias("lang_found"),
        best.alias("posterior_found"),
        names[(F.array_position("posterior", F.array_max("posterior")) - 1).cast("int")].alias("text_lang"),
    )


def of_documents(docs: DataFrame) -> DataFrame:
    """Documents as evidence rows: their source takes the place of a host."""
    none = F.lit(None).cast("string")
    return docs.select(
        "text",
        F.lit("document").alias("kind"),
        F.col("doc_id").cast("long").alias("doc_id"),
        none.cast("long").alias("page_id"),
        F.col("source").cast("string").alias("host"),
        none.alias("suffix"),
        none.alias("declared"),
    )


def keep_identified(docs: DataFrame, model: TextModel) -> DataFrame:
    """The documents whose language is accepted, with all their columns.

    A verdict belongs to a doc_id and a text, so repeated rows share it.
    """
    rows = of_documents(docs).withColumn("text_hash", F.xxhash64("text"))
    return without(docs, identify(rows, model).where("NOT accepted"))


def of_pages(pages: DataFrame) -> DataFrame:
    """Pages as evidence rows: visible text, host and suffix of the address, <html lang>."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    host = F.when(F.length(host) > 0, host)
    declared = F.lower(F.regexp_extract("html", r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    visible = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    none = F.lit(None).cast("string")
    return pages.select(
        visible.alias("text"),
        F.lit("page").alias("kind"),
        none.cast("long").alias("doc_id"),
        F.col("page_id").cast("long").alias("page_id"),
        host.alias("host"),
        F.when(host.contains("."), F.substring_index(host, ".", -1)).alias("suffix"),
        F.when(F.length(declared) > 0, declared).alias("declared"),
    )


def identify(rows: DataFrame, model: TextModel) -> DataFrame:
    """Languages of evidence rows; ``accepted`` where one language is likely enough."""
    scored = materialize(
        score_texts(rows.withColumn("has_text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))), model),
        "language-scores",
    )
    found = fuse(scored, model)
    sure = (
        F.col("has_text")
        & (F.col("lang_found") != UNKNOWN)
        & (F.col("posterior_found") >= MIN_POSTERIOR)
    )
    return found.select(
        *[c for c in rows.columns if c in ("kind", "doc_id", "page_id", "text_hash")],
        "lang_found",
        "posterior_found",
        "text_lang",
        sure.alias("accepted"),
    )
