import random

import numpy as np
import pytest

from spokewise.llm import language as L

VOICES = {"en": "the with and of house water", "de": "der und nicht haus wasser schön", "fr": "le avec maison été ça eau"}


def text(lang, seed, count=60):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOICES[lang].split()) for _ in range(count))


def model(spark):
    rows = [(k, text(lang, k), lang) for lang in VOICES for k in range(30)] + [(1, None, "en"), (2, "x", None), (3, "x", " ")]
    return L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def identify(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, lang int, chance string")
    return L.identify(pages, model(spark))


def test_text_decides_and_matches_direct_counting(spark):
    found = model(spark)
    assert found.languages == ["de", "en", "fr"]
    counts = np.zeros(L.BUCKETS)
    for k in range(30):
        np.add.at(counts, L.gram_buckets(text("de", k)), 1)
    assert found.grams[:, 0] == pytest.approx(np.log((counts + 0.5) / (counts + 0.5).sum()))
    rows = [(k, f"http://h{k}.org/", f"<html><body><p>{text(lang, 900 + k)}", 0, "") for k, lang in enumerate(["en", "de", "fr"] * 5)]
    right = {k: lang for k, lang in enumerate(["en", "de", "fr"] * 5)}
    result = identify(spark, rows).collect()
    assert {r.page_id: r.lang for r in result} == right and {r.page_id: r.text_lang for r in result} == right


def test_markup_and_host_decide_where_text_is_silent(spark):
    rows = [(k, f"http://a.example.de/{k}", f"<html lang='de-AT'><p>{text('de', k)}</p>", 0, "") for k in range(40)]
    rows += [(100, "http://a.example.de/x", "<html><body></body>", 0, ""), (101, None, '<html lang="fr"><body>', 0, "")]
    rows += [(102, "http://b.example.de/", None, 0, ""), (103, "bad", f"<html lang=de><p>{text('fr', 5, 200)}", 0, ""), (103, "bad", f"<html lang=de><p>{text('fr', 5, 200)}", 0, "")]
    found = {r.page_id: r for r in identify(spark, rows).collect()}
    assert found[100].lang == "de" and found[100].text_lang is None and found[100].declared is None
    assert found[101].lang == "fr" and found[101].declared == "fr"
    assert found[102].lang == "de" and found[102].probability < found[100].probability
    assert found[103].lang == "fr" and found[103].declared == "de"


def test_nothing_to_learn_or_judge(spark):
    assert identify(spark, [(1, "u", "h", 0, "")]).limit(0).count() == 0
    docs = spark.createDataFrame([(1, "x", None)], "doc_id long, text string, lang string")
    pages = spark.createDataFrame([(1, "http://u/", "<p>x")], "page_id long, url string, html string")
    row = L.identify(pages, L.fit(docs)).first()
    assert row.lang is None and row.host == "u"
    assert L.identify(pages.limit(0), model(spark)).count() == 0
