"""SQL that gives the rows of the corpus queries SQL can express.

Written from the contracts, not from the Spark code: positions by plain sums, links by
comparing all pairs, groups by recursion. It is meant for small tables.
"""

from __future__ import annotations

from tallyspark.llm import pii

# The patterns as a contract states them, without the guards against slow runs.
_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}

_VALID = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda x: len(ltrim(x, '0')) > 3 "
    "OR TRY_CAST(ltrim(x, '0') AS INT) > 255)) = 0",
    "card": "len(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(range(len(digits)), lambda i: "
    "CASE WHEN i % 2 = 0 THEN digits[len(digits) - i]::INT "
    "ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][digits[len(digits) - i]::INT + 1] END)) % 10 = 0",
    "phone": "len(digits) BETWEEN 10 AND 15",
    "iban": "len(plain) BETWEEN 15 AND 34 AND list_reduce(list_transform(range(len(plain)), lambda i: "
    "ascii((plain[5:] || plain[:4])[i + 1])::BIGINT), lambda acc, c: "
    "CASE WHEN c < 58 THEN (acc * 10 + c - 48) % 97 ELSE (acc * 100 + c - 55) % 97 END, 0::BIGINT) = 1",
    "ssn": "NOT regexp_matches(m, '^(?:000|666|9)|-00-|0000$')",
}


def _pii_sql() -> str:
    kinds = "\nUNION ALL\n".join(
        f"""SELECT doc_id, t, '{kind}' AS kind, {rank} AS rank, {pii.SCORES[kind]}::DOUBLE AS base,
    m, start, start + length(m) AS stop, {_VALID[kind]} AS valid,
    regexp_matches(before, '(?:^|[^a-z0-9_])(?:{pii.RAISING[kind]})')
      OR regexp_matches(behind, '(?:^|[^a-z0-9_])(?:{pii.RAISING[kind]})') AS raised,
    regexp_matches(before, '(?:^|[^a-z0-9_])(?:{pii.LOWERING})(?:$|[^a-z0-9_])')
      OR regexp_matches(behind, '(?:^|[^a-z0-9_])(?:{pii.LOWERING})(?:$|[^a-z0-9_])') AS lowered
FROM (
  SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS digits, replace(m, ' ', '') AS plain,
    lower(substring(t, greatest(start - {pii.CONTEXT_CHARS}, 0) + 1, start - greatest(start - {pii.CONTEXT_CHARS}, 0)))
      AS before,
    lower(substring(t, start + length(m) + 1, {pii.CONTEXT_CHARS})) AS behind
  FROM (
    SELECT doc_id, t, found[i] AS m,
      (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start
    FROM (
      SELECT *, unnest(range(1, len(found) + 1)) AS i
      FROM (
        SELECT doc_id, t, regexp_extract_all(t, '{_PATTERNS[kind]}') AS found,
          string_split_regex(t, '{_PATTERNS[kind]}') AS gaps
        FROM texts
      )
    )
  )
)"""
        for rank, kind in enumerate(pii.KINDS)
    )
    added = ", ".join(f"'{kind}'" for kind in pii.ADDED_KINDS)
    counts = ", ".join(f"count(kind) FILTER (kind = '{kind}') AS n_{kind}" for kind in pii.BASE_KINDS)
    span = "kind || ':' || start || ':' || stop"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({kinds}),
scored AS (
  SELECT *, least(1.0, base + CASE WHEN raised THEN {pii.CONTEXT_WEIGHT} ELSE 0 END
    - CASE WHEN lowered THEN {pii.CONTEXT_WEIGHT} ELSE 0 END)::DOUBLE AS score
  FROM found WHERE valid
),
kept AS (SELECT * FROM scored WHERE kind NOT IN ({added}) OR score >= {pii.THRESHOLD})
SELECT d.doc_id, {counts},
  sha256(coalesce(string_agg({span}, ',' ORDER BY start, rank) FILTER (kind NOT IN ({added})), '')) AS base_sha256,
  coalesce(string_agg({span}, ',' ORDER BY start, rank), '') AS spans,
  coalesce(string_agg(printf('%.2f', score), ',' ORDER BY start, rank), '') AS scores
FROM texts d LEFT JOIN kept k ON d.doc_id = k.doc_id
GROUP BY d.doc_id"""


_BASE32 = " || ".join(
    f"""substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hash, {5 * block + 1}, 5))::INT >> {shift}) & 31) + 1, 1)"""
    for block in range(8)
    for shift in (15, 10, 5, 0)
)

_WARC = f"""
WITH payloads AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hash,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest
  FROM pages
)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> largest THEN largest END AS refers_to,
  url AS target_uri
FROM payloads"""

_VECTORS = """
WITH RECURSIVE valid AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM valid a JOIN valid b
  ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    AND list_cosine_similarity(a.e, b.e) >= 0.93
),
reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x),
least_id AS (SELECT x, least(x, min(y)) AS component FROM reach GROUP BY x)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, coalesce(c.component, v.vec_id) AS component_id,
  v.vec_id = coalesce(c.component, v.vec_id) AS kept
FROM embeddings v LEFT JOIN degree d ON v.vec_id = d.x LEFT JOIN least_id c ON v.vec_id = c.x"""

_SHINGLES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
    range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
),
entries AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared_counts AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS k
  FROM entries a JOIN entries b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL
),
links AS (SELECT x, y FROM shared_counts WHERE 100 * k >= 80 * (nx + ny - k)),
reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
),
least_id AS (SELECT x, least(x, min(y)) AS component FROM reach GROUP BY x)
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(c.component, s.doc_id) AS component_id
FROM sets s LEFT JOIN least_id c ON s.doc_id = c.x"""

# CRC-32 by half bytes. The remainders of the 16 half bytes.
_REMAINDERS = [
    "0x00000000", "0x1DB71064", "0x3B6E20C8", "0x26D930AC", "0x76DC4190", "0x6B6B51F4", "0x4DB26158", "0x5005713C",
    "0xEDB88320", "0xF00F9344", "0xD6D6A3E8", "0xCB61B38C", "0x9B64C2B0", "0x86D3D2D4", "0xA00AE278", "0xBDBDF21C",
]


def _crc32(text: str) -> str:
    remainders = "[" + ", ".join(str(int(r, 16)) for r in _REMAINDERS) + "]::BIGINT[]"

    def half(c: str) -> str:
        return f"xor(({c}) >> 4, ({remainders})[(({c}) & 15) + 1])"

    data = f"hex(encode({text}))"
    # Of each byte the lower half goes first.
    halves = f"list_transform(range(length({data})), lambda i: ('0x' || {data}[xor(i, 1) + 1])::BIGINT)"
    step = half("xor(c, b)")
    return f"xor(list_reduce({halves}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


_SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
),
hashed AS (SELECT run, {_crc32("doc_id || ':' || run")} AS h FROM runs WHERE length(run) >= 7),
words AS (
  SELECT word, count(*) AS n
  FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
      ELSE run END AS word FROM hashed
  )
  WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
),
shorter AS (
  SELECT word, n, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
),
links AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n
  FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
),
best AS (
  SELECT word, n, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near,
    max(near_n) AS near_n
  FROM links GROUP BY word, n
),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
    CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form,
    CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
),
chain(word, root) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.n::BIGINT AS n, f.n_near::BIGINT AS n_near, f.form, f.form_n::BIGINT AS form_n, c.root
FROM forms f JOIN chain c ON f.word = c.word
WHERE (SELECT form FROM forms g WHERE g.word = c.root) IS NULL"""


def _number(k: int) -> str:
    return f"('0x' || substr(sha256('1:' || coalesce(doc_id::VARCHAR, '')), {8 * k + 1}, 8))::BIGINT"


_FILL_IN = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    {", ".join(f"{_number(k)} AS h{k + 1}" for k in range(4))}
  FROM documents
),
cuts AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
    greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
      THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM texts
),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
    array_to_string(u[b + 1:], '') AS s
  FROM cuts
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""

ORACLE_SQL: dict[str, str] = {
    "op1_pii": _pii_sql(),
    "op3_warc": _WARC,
    "op8_embedding_dedup": _VECTORS,
    "op10_jaccard_join": _SHINGLES,
    "op12_spelling_variants": _SPELLING,
    "op13_fill_in_middle": _FILL_IN,
}
