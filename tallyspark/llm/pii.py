"""Personal data: patterns propose spans, checksums confirm, context words adjust.

Built-in column functions only. A pattern's matches come from ``regexp_extract_all``
and the text between them from ``split``; running sums of both lengths give the
places, in code points. Context words are looked for on both sides of a span.

Defined results: a null text counts as empty; an empty text has no spans. Very long texts
are read whole, in time linear in their length and number of spans: pieces of a text are
cut from an array of its blocks and not from the text. Repeated rows are each answered.
Extra columns pass through; the columns added here replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, with possessive repeats and run starts added
# so that no match takes more than linear time. `\G` is the end of the last match.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = (
    r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9_])"
)
SSN = r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])"

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn")
KINDS = BASE_KINDS + ADDED_KINDS
PATTERNS = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE, IBAN, SSN), strict=True))

# Score of a confirmed span before its context, and the words that raise or lower it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
RAISING = {
    "email": "mail|contact|write|reach",
    "ip": "address|host|server|login|client",
    "card": "card|visa|credit|debit|payment|mastercard",
    "phone": "phone|call|tel|mobile|fax|whatsapp",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social security|tax id|taxpayer",
}
LOWERING = "version|release|chapter|section|isbn|serial|invoice|build"
CONTEXT_CHARS = 40
CONTEXT_WEIGHT = 0.2
THRESHOLD = 0.5

# Running sums append to arrays of at most this length, which keeps them near linear.
CHUNK = 256

# Code points of a block of a text; a shorter text is one block.
BLOCK = 4096


def _blocks(text: Column) -> Column:
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.when(F.length(text) <= BLOCK, F.array(text)).otherwise(cut)


def _cut(blocks: Column, start: Column, end: Column) -> Column:
    """The code points from start (at least 0) to end, which may lie behind the last one."""
    first, last = (F.floor(place / BLOCK).cast("int") for place in (start, end))
    offset = (start % BLOCK + 1).cast("int")
    head = F.coalesce(F.get(blocks, first), F.lit(""))
    tail = F.substring(F.coalesce(F.get(blocks, last), F.lit("")), F.lit(1), (end % BLOCK).cast("int"))
    between = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    return F.when(first == last, F.substring(head, offset, (end - start).cast("int"))).otherwise(
        F.concat(F.substr(head, offset), between, tail)
    )


def _running_starts(steps: Column) -> Column:
    """Start of each match, for array<struct<gap, len>> in text order."""
    empty = F.expr("cast(array() as array<bigint>)")

    def run(part: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(F.lit(0).cast("long").alias("pos"), empty.alias("out")),
            lambda acc, x: F.struct(
                (acc["pos"] + x["gap"] + x["len"]).alias("pos"),
                F.concat(acc["out"], F.array(acc["pos"] + x["gap"])).alias("out"),
            ),
        )

    parts = F.transform(
        F.sequence(F.lit(0), F.size(steps) - 1, F.lit(CHUNK)),
        lambda at: run(F.slice(steps, at + 1, CHUNK)),
    )
    joined = F.aggregate(
        parts,
        F.struct(
            F.lit(0).cast("long").alias("pos"),
            F.expr("cast(array() as array<array<bigint>>)").alias("out"),
        ),
        lambda acc, x: F.struct(
            (acc["pos"] + x["pos"]).alias("pos"),
            F.concat(acc["out"], F.array(F.transform(x["out"], lambda s: s + acc["pos"]))).alias("out"),
        ),
    )
    return F.flatten(joined["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc
        + F.when(
            i % 2 == 0,
            F.substring(digits, -i, F.lit(1)).cast("int") * 2
            - F.when(F.substring(digits, -i, F.lit(1)).cast("int") > 4, 9).otherwise(0),
        ).otherwise(F.substring(digits, -i, F.lit(1)).cast("int")),
    )
    return total % 10 == 0


def mod_97(iban: Column) -> Column:
    """Whether an account number, spaces removed, passes the mod-97 checksum."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        char = F.substring(turned, i, F.lit(1))
        return F.when(char.rlike("[0-9]"), (acc * 10 + char.try_cast("int")) % 97).otherwise(
            (acc * 100 + F.ascii(char) - 55) % 97
        )

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return found.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(_digits(found)).between(14, 19) & luhn(_digits(found))
    if kind == "phone":
        return F.length(_digits(found)).between(10, 15)
    if kind == "iban":
        plain = F.replace(found, F.lit(" "), F.lit(""))
        return F.length(plain).between(15, 34) & mod_97(plain)
    if kind == "ssn":
        return ~found.rlike("^(?:000|666|9)|-00-|0000$")
    return F.lit(True)


def _has(context: tuple[Column, Column], words: str) -> Column:
    return context[0].rlike(words) | context[1].rlike(words)


def _score(kind: str, blocks: Column, start: Column, end: Column) -> Column:
    sides = (_cut(blocks, F.greatest(start - CONTEXT_CHARS, F.lit(0)), start), _cut(blocks, end, end + CONTEXT_CHARS))
    context = tuple(F.lower(side) for side in sides)
    raised = F.when(_has(context, rf"(?<![a-z0-9_])(?:{RAISING[kind]})"), CONTEXT_WEIGHT).otherwise(0.0)
    lowered = F.when(_has(context, rf"(?<![a-z0-9_])(?:{LOWERING})(?![a-z0-9_])"), CONTEXT_WEIGHT).otherwise(0.0)
    return F.least(F.lit(1.0), F.lit(SCORES[kind]) + raised - lowered)


def _span(kind: str, rank: int, blocks: Column):
    def build(step: Column, start: Column) -> Column:
        end = start + step["len"]
        return F.struct(
            start.alias("start"),
            F.lit(rank).alias("kind_rank"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            F.when(step["valid"], _score(kind, blocks, start, end)).alias("score"),
        )

    return build


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``spans``: array of (start, kind_rank, end, kind, score), ordered by place and kind.

    Spans of the base kinds always stay; an added kind needs a score of ``THRESHOLD``.
    """
    return _found(docs, text).drop("_blocks")


def _found(docs: DataFrame, text: str) -> DataFrame:
    """The spans, and the blocks of texts that have a confirmed one."""
    whole = F.coalesce(F.col(text), F.lit(""))
    out = docs
    for kind in KINDS:
        out = out.withColumn(f"_{kind}", F.regexp_extract_all(whole, F.lit(PATTERNS[kind]), F.lit(0)))
    for kind in KINDS:
        found = F.col(f"_{kind}")
        gaps = F.split(whole, PATTERNS[kind], -1)
        out = out.withColumn(
            f"_{kind}_steps",
            F.when(
                F.size(found) > 0,
                F.zip_with(
                    F.slice(gaps, F.lit(1), F.size(found)),
                    found,
                    lambda g, m: F.struct(
                        F.length(g).cast("long").alias("gap"),
                        F.length(m).cast("long").alias("len"),
                        _valid(kind, m).alias("valid"),
                    ),
                ),
            ),
        )
    # Only texts with a confirmed span are cut into blocks.
    some = F.lit(False)
    for kind in KINDS:
        some = some | F.coalesce(F.exists(f"_{kind}_steps", lambda step: step["valid"]), F.lit(False))
    out = out.withColumn("_blocks", F.when(some, _blocks(whole)))
    none = F.expr(
        "cast(array() as array<struct<start:bigint,kind_rank:int,end:bigint,kind:string,score:double>>)"
    )
    for rank, kind in enumerate(KINDS):
        steps = F.col(f"_{kind}_steps")
        spans = F.zip_with(steps, _running_starts(steps), _span(kind, rank, F.col("_blocks")))
        least = F.lit(THRESHOLD if kind in ADDED_KINDS else float("-inf"))
        out = out.withColumn(
            f"_{kind}_spans",
            F.when(
                steps.isNotNull(), F.filter(spans, lambda s: s["score"].isNotNull() & (s["score"] >= least))
            ).otherwise(none),
        )
    every = F.array_sort(F.concat(*[F.col(f"_{kind}_spans") for kind in KINDS]))
    helpers = [f"_{kind}{end}" for kind in KINDS for end in ("", "_steps", "_spans")]
    return out.withColumn("spans", every).drop(*helpers)


def listing(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def counts(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(found: DataFrame) -> DataFrame:
    """One row per document: counts, hash of the base spans, listing of all spans."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind_rank"] < len(BASE_KINDS))
    scores = F.array_join(F.transform(spans, lambda s: F.format_number(s["score"], 2)), ",")
    return found.select(
        "doc_id",
        *[counts(spans, kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(listing(base).cast("binary"), 256).alias("base_sha256"),
        listing(spans).alias("spans"),
        scores.alias("scores"),
    )


def _covered(spans: Column) -> Column:
    """For each span the largest end before it, and behind the last one the largest of all."""
    empty = F.expr("cast(array() as array<bigint>)")

    def run(part: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(F.lit(0).cast("long").alias("top"), empty.alias("out")),
            lambda acc, x: F.struct(
                F.greatest(acc["top"], x["end"]).alias("top"),
                F.concat(acc["out"], F.array(acc["top"])).alias("out"),
            ),
        )

    parts = F.transform(
        F.sequence(F.lit(0), F.size(spans) - 1, F.lit(CHUNK)), lambda at: run(F.slice(spans, at + 1, CHUNK))
    )
    return F.aggregate(
        parts,
        F.struct(
            F.lit(0).cast("long").alias("top"), F.expr("cast(array() as array<array<bigint>>)").alias("out")
        ),
        lambda acc, x: F.struct(
            F.greatest(acc["top"], x["top"]).alias("top"),
            F.concat(acc["out"], F.array(F.transform(x["out"], lambda t: F.greatest(t, acc["top"])))).alias("out"),
        ),
        lambda acc: F.concat(F.flatten(acc["out"]), F.array(acc["top"])),
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span by its kind in brackets; overlapping spans merge under the first."""
    whole = F.col(text)
    found = _found(docs, text)
    found = found.withColumn("_covered", F.when(F.size("spans") > 0, _covered(F.col("spans"))))

    def piece(span: Column, covered: Column) -> Column:
        tag = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        apart = F.concat(_cut(F.col("_blocks"), covered, span["start"]), tag)
        return F.when(span["start"] >= covered, apart).otherwise("")

    pieces = F.zip_with("spans", F.slice("_covered", F.lit(1), F.size("spans")), piece)
    end = F.length(whole).cast("long")
    rest = _cut(F.col("_blocks"), F.element_at("_covered", -1), end)
    clean = F.concat(F.array_join(pieces, ""), rest)
    return found.withColumn(text, F.when(F.col("_covered").isNull(), whole).otherwise(clean)).drop(
        "spans", "_covered", "_blocks"
    )
