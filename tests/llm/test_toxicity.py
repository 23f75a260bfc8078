"""Features against plain zstandard, and what is learnt from."""

import random

import numpy as np
import zstandard
from pyspark.sql import functions as F

from tillroll.llm import toxicity

SCHEMA = "doc_id long, text string"
BAD = ["idiotic", "worthless", "pathetic", "garbage"]
PLAIN = [f"{a}{b}{c}" for a in ("th", "er", "on", "an", "re") for b in ("ab", "ed", "ing", "or", "is") for c in ("a", "en", "us", "ly")]


def texts_of(chance, number, words=120):
    labels = [i % 4 == 0 for i in range(number)]
    return labels, [" ".join(chance.choice(BAD) if bad and chance.random() < 0.1 else chance.choice(PLAIN) for _ in range(words))
                    for bad in labels]


def test_features_against_plain_compression():
    labels, texts = texts_of(random.Random(61), 200)
    toxic, ordinary = toxicity.dictionaries(*[[t for t, bad in zip(texts, labels) if bad == kind] for kind in (True, False)])
    assert not any(content.startswith(b"7\xa40\xec") for content in (toxic, ordinary))  # no tables, only text
    distance = toxicity.Distance(toxic, ordinary)

    def taken(content, word):
        compressor = zstandard.ZstdCompressor(
            dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            compression_params=zstandard.ZstdCompressionParameters(
                window_log=18, chain_log=16, hash_log=15, search_log=6, min_match=4, target_length=64,
                strategy=zstandard.STRATEGY_LAZY, write_content_size=False, write_checksum=False, write_dict_id=False))
        return len(compressor.compress(b" " + word + b" " + b"\n" * 24))

    for text in [*texts[:6], "É \U0001f600 Idiotic", "x"]:
        gaps = [taken(ordinary, w) - taken(toxic, w) for w in text.lower().encode().split()]
        top = sorted(gaps)[-3:]
        reached = [sum(gap >= threshold for gap in gaps) for threshold in toxicity.THRESHOLDS]
        expected = [max(gaps), np.mean(top), np.mean(gaps), np.log1p(len(gaps)),
                    *[n / len(gaps) for n in reached], *[np.log1p(n) for n in reached]]
        assert np.allclose(toxicity.features(distance, text), expected)
    assert toxicity.features(distance, None) == toxicity.features(distance, " \n") == [0.0] * toxicity.FEATURES


def test_long_labelled_texts_are_learnt_from_and_the_driver_gets_a_part(spark):
    chance = random.Random(62)
    labels, texts = texts_of(chance, 160, 30_000)  # every text has over 150,000 characters
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    marks = spark.createDataFrame([(i, int(bad)) for i, bad in enumerate(labels)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks.filter("doc_id < 120"))
    found = toxicity.score_texts(docs.filter("doc_id >= 120"), model).toPandas()
    assert (found.predicted == found.doc_id.map(lambda i: int(labels[i]))).mean() > 0.9


def test_repeated_ids_null_labels_and_clashing_columns(spark):
    labels, texts = texts_of(random.Random(63), 300)
    rows = list(enumerate(texts)) + [(5, texts[5])] * 300 + [(None, None), (5, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(
        [(i, int(bad)) for i, bad in enumerate(labels)] + [(None, 1), (7, None), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    again = toxicity.fit(docs.repartition(5), marks)
    assert np.allclose(model.weights, again.weights) and model.toxic == again.toxic
    own = docs.withColumns({"score": F.lit("x"), "predicted": F.lit(7.5), "order": F.lit(1), "x": F.lit(2)})
    found = toxicity.score_texts(own, model)
    assert found.count() == len(rows) and dict(found.dtypes)["score"] == "double" and set(found.columns) == {
        "doc_id", "score", "predicted", "order", "x"}
    assert found.select("doc_id", "score").distinct().filter("doc_id = 5").count() == 2  # its text and the null one
