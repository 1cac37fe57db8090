"""Personal data against Python's regular expressions and plain checksums."""

import hashlib
import re

from pyspark.sql import functions as F

from tallyspark.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None,
    "",
    "no data here",
    "a@b.c_x@y.z a@@b@c.d é a@b.c. ..@x.y x@y",
    "1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.4 é1.2.3.4 1.2.3",
    "+1+1 234 567-8901. +1 (462) 555-7216x +12345 +1234567890123456",
    "4962 2512 1335 9604é4962251213359604 12 4962251213359605",
    "🙂🙂 mail x@y.zz 🙂 +49 30 1234567 4962-2512-1335-9604",
    "1" * 5000,
    "a" * 30000 + "@b.c",
    "a@b.cc " * 1200 + "192.168.0.1",
    "🙂" * 255 + "a@b.cc" + "🙂" * 300 + "1.2.3.4",
]


def passes_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and passes_luhn(digits)
    return kind != "phone" or 10 <= len(digits) <= 15


def base_spans(text):
    found = [
        (m.start(), rank, f"{kind}:{m.start()}:{m.end()}")
        for rank, kind in enumerate(PATTERNS)
        for m in re.finditer(PATTERNS[kind], text or "")
        if valid(kind, m.group())
    ]
    return [span for _, _, span in sorted(found)]


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_base_spans(spark):
    rows = {r.doc_id: r for r in pii.digest(pii.find(documents(spark, TEXTS))).collect()}
    assert len(rows) == len(TEXTS)
    for doc_id, text in enumerate(TEXTS):
        expected = base_spans(text)
        row = rows[doc_id]
        assert row.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest(), text
        assert [s for s in row.spans.split(",") if s.split(":")[0] in PATTERNS] == expected
        for kind in PATTERNS:
            assert row[f"n_{kind}"] == sum(s.startswith(kind) for s in expected)


def test_checksums_and_context(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00 THE end",
        "IBAN DE88 3704 0044 0532 0130 00",
        "ssn 123-45-6789",
        "part 123-45-6789",
        "version 1.2.3.4",
        "host 1.2.3.4",
    ]
    rows = {r.doc_id: r for r in pii.digest(pii.find(documents(spark, texts))).collect()}
    assert rows[0].spans == "iban:5:32"
    assert "iban" not in rows[1].spans
    assert rows[2].spans == "ssn:4:15" and rows[3].spans == ""
    assert (rows[4].scores, rows[5].scores) == ("0.40", "0.80")


def test_context_on_both_sides(spark):
    texts = [
        "123-45-6789 is my SSN",
        "123-45-6789" + " " * 36 + " ssn",
        "123-45-6789" + " " * 37 + " ssn",
        "1.2.3.4 is the version",
        "🙂" * 250 + " 123-45-6789 " + "🙂" * 20 + " Social Security",
    ]
    rows = {r.doc_id: r for r in pii.digest(pii.find(documents(spark, texts))).collect()}
    assert [rows[k].spans.split(":")[0] for k in range(5)] == ["ssn", "ssn", "", "ip", "ssn"]
    assert rows[3].scores == "0.40"
    assert {r.doc_id: r.text for r in pii.redact(documents(spark, texts)).collect()}[0] == "[SSN] is my SSN"


def test_a_long_text_with_many_spans(spark):
    """30,000 spans in one text; cutting each out of the whole text would take minutes."""
    text = "é call a@b.cc, 192.168.0.1 ok\n" * 15_000
    row = pii.digest(pii.find(documents(spark, [text]))).first()
    assert (row.n_email, row.n_ip) == (15_000, 15_000)
    assert row.base_sha256 == hashlib.sha256(",".join(base_spans(text)).encode()).hexdigest()
    clean = pii.redact(documents(spark, [text])).first().text
    assert clean == "é call [EMAIL], [IP] ok\n" * 15_000


def test_redaction(spark):
    texts = ["a@b.cé +1 (462) 555-7216x", None, "", "x 1.2.3.4@b.c y", "plain"]
    rows = {r.doc_id: r for r in pii.redact(documents(spark, texts).withColumn("start", F.lit(1))).collect()}
    assert rows[0].text == "[EMAIL]é [PHONE]x"
    assert rows[1].text is None and rows[2].text == "" and rows[4].text == "plain"
    assert rows[3].text == "x [EMAIL] y"
    assert rows[0].start == 1


def test_empty_and_repeated(spark):
    assert pii.digest(pii.find(documents(spark, []))).collect() == []
    twice = documents(spark, ["a@b.c"]).unionAll(documents(spark, ["a@b.c"])).withColumn("spans", F.lit("own"))
    assert [r.n_email for r in pii.digest(pii.find(twice)).collect()] == [1, 1]


def test_no_python_in_the_plan(spark):
    plan = pii.digest(pii.find(documents(spark, TEXTS)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
