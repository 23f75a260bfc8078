"""Cases in which the operators once did less than the whole job."""

import random

import pytest
from pyspark.sql import functions as F

from tillroll.llm import html, language, neardup, quality, secrets, toxicity

SCHEMA = "doc_id long, text string, lang string, source string"


# near duplicates

def repeated_line_pairs(number):
    """Pairs of texts whose sets of shingles are alike at 0.8 or more, one text repeating a passage many times."""
    chance, pairs = random.Random(21), []
    for _ in range(number):
        own = [f"w{chance.randrange(10 ** 6)}" for _ in range(130)]
        passage = own[10:50]
        pairs.append((" ".join(own), " ".join(own[:50] + passage * 31 + own[50:])))
    return pairs


def test_texts_with_repeated_lines_are_candidates():
    missed = 0
    for one, other in repeated_line_pairs(300):
        keys = neardup._signed({"text_id": [b"1", b"2"], "doc_id": [1, 2], "text": [one, other]})["bands"].to_pylist()
        sets = [set(neardup.shingles(text)[0].tolist()) for text in (one, other)]
        assert len(sets[0] & sets[1]) >= 0.8 * len(sets[0] | sets[1])
        missed += not set(keys[0]) & set(keys[1])
    assert missed <= 1


def test_repeated_line_pairs_against_brute_force(spark):
    texts = [text for pair in repeated_line_pairs(60) for text in pair]
    docs = spark.createDataFrame([(i, text, "en", "s") for i, text in enumerate(texts)], SCHEMA)
    found = {row["doc_id"]: row["class_id"] for row in neardup.near_duplicates(docs).collect()}
    assert found == {i: i - i % 2 for i in range(len(texts))}


# quality

def test_every_length_has_a_real_upper_limit(spark):
    chance = random.Random(22)
    prose = lambda words: " ".join(chance.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(chance.randrange(90))
                                   for _ in range(words))
    # 40 good texts of about 2 KB, 25 of about 4 KB, 12 of about 9 KB: too few from 4 KB up.
    texts = [prose(words) for words, n in ((290, 40), (600, 25), (1300, 12)) for _ in range(n)]
    docs = spark.createDataFrame([(i, text, "en", "s") for i, text in enumerate(texts)], SCHEMA)
    limits = quality.fit_limits(docs, docs.select("doc_id"))
    assert all(limits[band][1] < 0.7 for band in range(22, 50))
    letters = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/"
    noise = [" ".join("".join(chance.choices(letters, k=60)) for _ in range(size // 61)) for size in (4200, 9000, 20000, 70000)]
    fine = [prose(words) for words in (600, 1300, 3000, 10000)]
    rows = spark.createDataFrame([(i, text, "en", "s") for i, text in enumerate(noise + fine)], SCHEMA)
    found = quality.quality_rules(rows, limits).toPandas().set_index("doc_id")
    assert found.kept.tolist() == [False] * 4 + [True] * 4
    assert (found.bad_chunks[:4] == 1).all()


# secrets

def test_a_secret_of_one_owner_is_live_in_any_number_of_documents(spark):
    own, shared = "ghp_a1B2c3D4e5F6g7H8i9J0", "ghp_Zz9Yy8Xx7Ww6Vv5Uu4Tt"
    rows = [(i, f"notes {i} {own}", "en", "hot") for i in range(40)]
    rows += [(100 + i, f"copy {own}", "en", "hot") for i in range(40)]
    rows += [(200 + i, f"see {shared} {i}", "en", f"o{i % 3}") for i in range(9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = secrets.find_secrets(docs).toPandas().set_index("doc_id")
    assert (found.n_live[found.index < 200] == 1).all() and (found.spans[found.index < 200] != "").all()
    assert (found.n_examples[found.index >= 200] == 1).all() and (found.spans[found.index >= 200] == "").all()
    texts = {row["doc_id"]: row["text"] for row in secrets.redact(docs).collect()}
    assert not any(own in text for text in texts.values()) and all(shared in texts[200 + i] for i in range(9))


# pages

@pytest.mark.parametrize(("page", "expected"), [
    ('<p>a <svg viewBox="0 0 1 1"/> b</p><p>c</p>', ["a b", "c"]),
    ('<p>a <svg><path d="x"/><text>x</text></svg> b</p><p>c</p>', ["a b", "c"]),
    ('<math/>a<iframe src="x" />b<object data="y"/>c<canvas/>d', ["abcd"]),
    ("<div>a <select><option>1<option>2</div><p>c", ["a", "c"]),
    ("<div>a<object data=x><p>y</div><p>c</p>", ["a", "c"]),
    ("a<noscript><div>no</div></noscript>b<template><p>t</p></template>c<title>x</title>d<script>'</p>'</script>e", ["abcde"])])
def test_embedded_elements_take_no_text_of_the_page(page, expected):
    assert html.blocks(f"<article>{page}</article>") == [(html.ARTICLE, text) for text in expected]
    assert language.page_text(f"<article>{page}</article>") == " ".join(expected)


# language

def test_rare_languages_are_learnt(spark):
    rows = [(i, f"the thing with edward {i}", "en", "hot") for i in range(600)]
    rows += [(1000 + i, f"ξψω ξψ ωω ψψξ {i}", "xx", "s") for i in range(3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language.train(docs, rows=50)
    assert model.languages == ("en", "xx")
    found = language.document_languages(docs.filter("doc_id >= 1000"), model).toPandas()
    assert found.text_language.tolist() == ["xx"] * 3 and found.language.tolist() == ["xx"] * 3
    assert language.keep_identified(docs, model).filter("lang = 'xx'").count() == 3
    many = spark.createDataFrame([(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)} " * 5, f"l{i:03}", "s") for i in range(260)], SCHEMA)
    assert len(language.train(many, rows=100).languages) == 260


def test_frames_within_articles_go(spark):
    notice, strip = "subscribe to our letter and never miss a story again", "tell your friends on all the networks you may use"
    long = "and then it goes on at some length about what happened there, which no other page of the host does, "
    rows = [(i, f"http://h.example/{i}", f"<main><p>{notice}</p><h1>title {i}</h1><p>{long} {'abcdefgh'[i]} {long} {i}</p><h2>Notes</h2>"
             f"<div>{strip}</div><p>note {i}, {long} {i * 7}</p><p>Share</p></main>") for i in range(6)]
    # One page has an open block too; variants of one article, and a passage that some articles share, stay.
    rows[5] = (*rows[5][:2], rows[5][2] + "<p>left over five</p>")
    rows += [(10 + i, "http://v.example/", f"<article><p>{long}</p><p>{strip}</p><p>version {i}</p></article>") for i in range(4)]
    rows += [(20 + i, "http://s.example/", f"<article><p>{long} {i}</p>{f'<p>{notice}</p>' if i < 4 else ''}</article>") for i in range(9)]
    found = {row["page_id"]: row["text"] for row in html.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    plain = lambda page: "\n\n".join(text for _, text in html.blocks(page))
    for i in range(6):
        expected = [text for _, text in html.blocks(rows[i][2]) if text not in (notice, strip, "Share")]
        assert found[i] == "\n\n".join(expected) and "Notes" in found[i]
    assert all(found[i] == plain(page) for i, _, page in rows[6:])


# toxicity

def test_the_driver_gets_one_text_per_labelled_id(spark, monkeypatch):
    rows = [(1, f"word {i} of the hot one", "en", "s") for i in range(300)] + [(i, f"word {i}", "en", "s") for i in range(2, 30)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)], "doc_id long, toxic int")
    texts, measured = [], []
    dictionaries, calibrate = toxicity.dictionaries, toxicity.calibrate
    monkeypatch.setattr(toxicity, "dictionaries", lambda *kinds: texts.append(sum(map(len, kinds))) or dictionaries(*kinds))
    monkeypatch.setattr(toxicity, "calibrate", lambda own, other, x, y: measured.append(len(x)) or calibrate(own, other, x, y))
    toxicity.fit(spark.createDataFrame(rows, SCHEMA), labels)
    assert len(texts) == len(measured) == 1 and 0 < texts[0] < 29 and texts[0] + measured[0] == 29
