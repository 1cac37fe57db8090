"""Languages of invented words, and each kind of evidence alone."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import language_id

SYLLABLES = {"xx": ["ka", "lo", "mi", "tu"], "yy": ["sch", "eng", "urt", "ob"]}


def sentence(lang, rng, words=40):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = [(k, sentence(lang, rng), lang) for k, lang in enumerate(["xx", "yy"] * 60)]
    rows += [(1000, None, "xx"), (1001, "", "yy"), (1002, "lolo", None), (1003, "kalo", "")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def model(labelled):
    return language_id.fit(labelled)


def evidence(spark, rows):
    return spark.createDataFrame(
        [(None, *row) for row in rows],
        "doc_id long, page_id long, text string, host string, suffix string, declared string, kind string",
    )


def test_text_decides(spark, labelled, model):
    rng = random.Random(2)
    assert model.languages == ["xx", "yy", "und"]
    rows = [(k, sentence(lang, rng, 8), "s") for k, lang in enumerate(["xx", "yy"] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = language_id.identify(language_id.of_documents(docs), model).collect()
    assert len(found) == 40
    assert all(r.lang_found == ("xx", "yy")[r.doc_id % 2] and r.accepted for r in found)


def test_other_evidence_decides_where_the_text_does_not(spark, model):
    rng = random.Random(3)
    known = [(k, sentence("yy", rng), "h.yy", "yy", "yy", "page") for k in range(30)]
    known += [(100 + k, sentence("xx", rng), "h.xx", "xx", "xx", "page") for k in range(30)]
    silent = [
        (200, "q", "h.yy", "yy", None, "page"),
        (201, "q", "new.xx", "xx", None, "page"),
        (202, "q", None, None, "yy", "page"),
        (203, None, "h.xx", "xx", "xx", "page"),
        (204, "9 9 9", "h.xx", "xx", "xx", "page"),
    ]
    found = {r.page_id: r for r in language_id.identify(evidence(spark, known + silent), model).collect()}
    assert [found[k].lang_found for k in (200, 201, 202, 203)] == ["yy", "xx", "yy", "xx"]
    assert not found[203].accepted and not found[204].accepted


def test_strange_text_is_unknown(spark, model):
    docs = spark.createDataFrame([(1, "日本語のテキスト" * 10, "s")], "doc_id long, text string, source string")
    row = language_id.identify(language_id.of_documents(docs), model).first()
    assert row.lang_found == "und" and not row.accepted


def test_keep_identified(spark, model):
    rng = random.Random(4)
    good = sentence("xx", rng)
    rows = [(1, good, "a", 7), (1, good, "a", 7), (1, "", "a", 8), (None, good, None, 9), (2, None, "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, score long")
    kept = language_id.keep_identified(docs, model).collect()
    assert sorted(r.score for r in kept) == [7, 7, 9]


def test_pages(spark):
    rows = [
        (1, "http://u@www.a.example.DE:80/x?y", '<HTML class=c LANG="de-AT"><script>var x="</p>"</script><p>Hi</p>'),
        (2, "no address", None),
        (3, None, "<p>x</p>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in language_id.of_pages(pages).collect()}
    assert (found[1].host, found[1].suffix, found[1].declared) == ("www.a.example.de", "de", "de")
    assert found[1].text.split() == ["Hi"]
    assert (found[2].host, found[2].suffix, found[2].declared, found[2].text) == (None,) * 4
    assert found[3].host is None and found[3].declared is None


def test_empty_tables(spark, labelled, model):
    none = labelled.where(F.lit(False))
    empty_model = language_id.fit(none)
    assert empty_model.languages == ["und"]
    docs = spark.createDataFrame([(1, "lolo", "s")], "doc_id long, text string, source string")
    assert language_id.identify(language_id.of_documents(docs), empty_model).first().lang_found == "und"
    assert language_id.identify(language_id.of_documents(docs.where("doc_id > 5")), model).collect() == []


def brute_force(model, rows):
    """The fused posterior of (text, host, suffix, declared) rows, key by key in plain loops."""
    classes = len(model.languages)
    flat = np.full(classes, (1 - language_id.UNKNOWN_PRIOR) / (classes - 1))
    flat[-1] = language_id.UNKNOWN_PRIOR

    def normal(logs):
        shares = np.exp(logs - logs.max())
        return shares / shares.sum()

    texts = [model.scores(text) if text else np.zeros(classes) for text, *_ in rows]
    own = [normal(scores + np.log(flat)) for scores in texts]
    total = sum(own)
    world = (total + flat) / (total.sum() + 1)

    def mass(chosen):
        return sum((p for p, row in zip(own, rows, strict=True) if chosen(row)), np.zeros(classes))

    def smoothed(found, above):
        return (found + language_id.HOST_STRENGTH * above) / (found.sum() + language_id.HOST_STRENGTH)

    def domain_of(row):
        return None if row[2] is None else ".".join(row[1].split(".")[-2:])

    def likelihood(column, value):
        if value is None:
            return np.zeros(classes)
        found = mass(lambda r: r[column] == value)
        strength = language_id.DECLARED_STRENGTH
        return np.log((found + strength * found.sum() / total.sum() + 1e-9) / (total + strength))

    results = []
    for scores, row in zip(texts, rows, strict=True):
        prior = world
        if row[1] is not None:
            domain = smoothed(mass(lambda r: r[1] is not None and domain_of(r) == domain_of(row)), world)
            prior = smoothed(mass(lambda r: (domain_of(r), r[1]) == (domain_of(row), row[1])), domain)
        results.append(normal(scores + np.log(prior) + likelihood(2, row[2]) + likelihood(3, row[3])))
    return results


def test_posteriors_against_brute_force(spark, model):
    """All kinds of evidence, present and absent, in agreement and not."""
    rng = random.Random(6)
    hosts = ["a.one.xx", "b.one.xx", "one.xx", "c.two.yy", "d.three.yy", "src1", None]
    rows = []
    for _ in range(120):
        host = rng.choice(hosts)
        lang = "yy" if host and host.endswith("yy") else rng.choice(["xx", "yy"])
        text = rng.choice([None, "", "q", "9", sentence(lang, rng, 1), sentence(lang, rng, 12), "日本語のテキスト"])
        suffix = host.rsplit(".")[-1] if host and "." in host else None
        rows.append((text, host, suffix, rng.choice([None, lang, "zz"])))
    found = {
        r.page_id: r
        for r in language_id.identify(evidence(spark, [(k, *row, "page") for k, row in enumerate(rows)]), model).collect()
    }
    for k, expected in enumerate(brute_force(model, rows)):
        assert found[k].posterior_found == pytest.approx(expected.max(), rel=1e-9)
        assert found[k].lang_found == model.languages[int(expected.argmax())]


def test_a_suffix_speaks_beside_its_host(spark, model):
    """A host seen once, whose text says nothing, has the language of its suffix."""
    rng = random.Random(7)
    known = [(k, sentence("yy", rng), f"h{k}.d{k}.yy", "yy", None, "page") for k in range(30)]
    known += [(100 + k, sentence("xx", rng), f"h{k}.d{k}.xx", "xx", None, "page") for k in range(60)]
    rows = [*known, (200, "q", "new.host.yy", "yy", None, "page"), (201, "q", "new.host", None, None, "page")]
    found = {r.page_id: r.lang_found for r in language_id.identify(evidence(spark, rows), model).collect()}
    assert (found[200], found[201]) == ("yy", "xx")


def test_very_long_texts(spark, model):
    rng = random.Random(8)
    rows = [(1, sentence("yy", rng, 150_000), "s"), (2, "q" * 1_000_000, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in language_id.identify(language_id.of_documents(docs), model).collect()}
    assert found[1].lang_found == "yy" and found[1].accepted
    assert not found[2].accepted
