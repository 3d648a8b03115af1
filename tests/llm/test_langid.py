import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm.langid import (
    UNDETERMINED, Model, fit, host_levels, identify, keep_identified, page_language, page_text, primary,
)


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(spark, corpus):
    """Fitted on a part of the rows, judged on the rest by text alone."""
    model = fit(corpus.where("doc_id % 2 = 0"), fit_rows=60)
    assert model.languages == ("de", "en", "es", "fr", UNDETERMINED)
    rest = corpus.where("doc_id % 2 = 1")
    found = identify(rest, model).join(rest, F.col("id") == F.col("doc_id"))
    right = found.where("language = lang").count() / found.count()
    assert right >= 0.98 and found.where("not kept").count() <= 2


def test_junk_is_rejected_and_prose_kept(spark, corpus):
    model, draw = fit(corpus), random.Random(1)
    junk = ["".join(draw.choices("bcdfghjkqvwxz", k=9)) + " " for _ in range(30)]
    frame = spark.createDataFrame([(1, "".join(junk), None, "x"), (2, corpus.first()["text"], None, "x")], "doc_id long, text string, lang string, source string")
    decided = identify(frame, model, declared=F.col("lang"), levels=[F.col("source")])
    assert [row["doc_id"] for row in keep_identified(frame, decided).collect()] == [2]


def brute(model, rows, reliability, strength):
    """rows of (text, declared, host) -> posteriors, with host counts smoothed towards the corpus'."""
    size = len(model.languages)
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    likely = [model.log_likelihood(text) / 3 for text, _, _ in rows]
    shares = [soft(x) for x in likely]
    found = []
    for i, (_, declared, host) in enumerate(rows):
        others = [shares[j] for j in range(len(rows)) if j != i]
        near = [shares[j] for j in range(len(rows)) if j != i and rows[j][2] == host]
        prior = (sum(others, np.zeros(size)) + strength / size) / (len(others) + strength)
        prior = (sum(near, np.zeros(size)) + strength * prior) / (len(near) + strength)
        stated = np.zeros(size)
        if declared in model.languages:
            stated = np.log([reliability if name == declared else (1 - reliability) / (size - 1) for name in model.languages])
        found.append(soft(likely[i] + np.log(prior) + stated))
    return found


def test_fusion_against_brute_force(spark, corpus):
    model = fit(corpus)
    texts = ["the", "der", "que", "", None, "le la", "and of the"] * 4
    rows = [(text, [None, "en", "de-DE", "xx"][i % 4], f"h{i % 3}") for i, text in enumerate(texts)]
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id long, text string, lang string, host string")
    got = {row["id"]: row for row in identify(frame, model, declared=F.col("lang"), levels=[F.col("host")]).collect()}
    wanted = brute(model, [(text, (declared or "")[:2] or None, host) for text, declared, host in rows], 0.9, 10.0)
    for i, posterior in enumerate(wanted):
        assert got[i]["confidence"] == pytest.approx(posterior.max(), rel=1e-9)
        assert got[i]["language"] == model.languages[int(posterior.argmax())]


def test_each_kind_of_evidence_decides_a_text_without_words(spark, corpus):
    model = fit(corpus)
    prose = {language: corpus.where(F.col("lang") == language).first()["text"] for language in model.languages[:-1]}
    pages = spark.createDataFrame([
        (1, "http://a.example.fr/x", "<p>12</p>"), (2, "http://b.example.com/", "<html lang='de-AT'><p>12</p>"),
        *[(10 + i, f"http://{'c' if language == 'es' else language}.example.com/{i}", f"<p>{text}</p>")
          for i, (language, text) in enumerate([*prose.items()] * 10)],
        (3, "http://c.example.com/y", "<p>12</p>")], "page_id long, url string, html string")
    suffix, domain, host = host_levels(F.col("url"))
    found = identify(pages, model, "page_id", page_text(F.col("html")), page_language(F.col("html")), suffix, [suffix, domain, host])
    got = {row["id"]: row["language"] for row in found.collect()}
    assert (got[1], got[2], got[3]) == ("fr", "de", "es")


def test_every_declared_language(spark):
    """More than 64 languages, each of words of its own, and one with a single row."""
    draw = random.Random(3)
    code = lambda i: f"q{chr(97 + i // 26)}{chr(97 + i % 26)}"
    words = {code(i): ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(20)] for i in range(71)}
    rows = [(language, " ".join(draw.choices(own, k=60))) for language, own in words.items()
            for _ in range(1 if language == code(70) else 6)]
    frame = spark.createDataFrame([(i, text, language, "h") for i, (language, text) in enumerate(rows)],
                                  "doc_id long, text string, lang string, source string")
    model = fit(frame)
    assert len(model.languages) == 71
    decided = identify(frame, model, declared=F.col("lang"), levels=[F.col("source")])
    assert {row["id"]: (row["language"], row["kept"]) for row in decided.collect()} == {
        i: (language, True) for i, (language, _) in enumerate(rows)}


def test_address_and_markup(spark):
    frame = spark.createDataFrame([("https://u:p@Www.Example.co.uk:80/a?b", "<HTML class=x LANG=en-GB><script>x<y</script>a<b>c</b><!-- d --></html>")], "u string, h string")
    row = frame.select(*host_levels(F.col("u")), primary(page_language(F.col("h"))), F.trim(F.regexp_replace(page_text(F.col("h")), " +", " "))).first()
    assert tuple(row) == ("uk", "co.uk", "www.example.co.uk", "en", "a c")


def test_defined_results(spark, documents, corpus):
    model = fit(corpus)
    frame = documents([(1, None), (1, None), (None, ""), (2, "12 34"), (3, "the of and " * 100_000)])
    decided = identify(frame, model, declared=F.col("lang"), levels=[F.col("source")])
    assert decided.count() == 5 and {row["language"] for row in decided.collect()} == {"en"}
    kept = keep_identified(frame, decided)
    assert kept.columns == frame.columns and kept.count() == 5
    assert identify(documents([]), model).count() == 0
    alone = fit(documents([]))
    assert alone.languages == (UNDETERMINED,) and identify(frame, alone).where("kept").count() == 0
    assert isinstance(alone, Model)
