"""Every link of two texts that share a band, in buckets of any size."""

import random

import numpy as np
import pytest

from tillroll.llm import components, neardup
from tillroll.operators import lookup

SCHEMA = "doc_id long, text string"


def alike(chance, kinds, copies, others, apart=3, near=3):
    """Texts around one base: ``kinds`` that differ from each other too much for a link, with ``copies`` each that are
    linked to their own kind only, and ``others`` that are linked to none."""
    base, texts = [f"w{chance.randrange(9999)}" for _ in range(160)], []
    for number in range(kinds + others):
        kind = list(base)
        for at in chance.sample(range(160), apart):
            kind[at] = f"k{number}x{at}"
        texts.append(kind)
        for _ in range(copies if number < kinds else 0):
            own = list(kind)
            for at in chance.sample(range(160), near):
                own[at] = f"n{chance.randrange(10 ** 6)}"
            texts.append(own)
    return [" ".join(text) for text in texts]


def expected_classes(texts):
    """The least number of a class of texts whose candidates are all looked at: those that share a band."""
    sets = [neardup.shingles(text) for text in texts]
    found = neardup.signatures(
        np.concatenate([own for own, _ in sets]), np.concatenate([neardup.weights_of(n) for _, n in sets]),
        np.concatenate([[0], np.cumsum([len(own) for own, _ in sets])]))
    keys, root, links = neardup.band_keys(found), list(range(len(texts))), 0
    for i in range(len(texts)):
        for j in range(i):
            if (keys[i] == keys[j]).any() and neardup.probability_jaccard(
                    sets[i][0], neardup.weights_of(sets[i][1]), sets[j][0], neardup.weights_of(sets[j][1])) >= neardup.SIMILARITY:
                low, high = sorted((root[i], root[j]))
                root = [low if at == high else at for at in root]
                links += 1
    return root, links


def test_no_link_is_lost_in_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 7, raising=False)
    texts = alike(random.Random(71), kinds=150, copies=1, others=60)
    classes, links = expected_classes(texts)
    assert links >= 140 and len(set(classes)) > 140
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    found = {row["doc_id"]: row["class_id"] for row in neardup.near_duplicates(docs).collect()}
    assert [found[i] for i in range(len(texts))] == classes


def test_one_large_class_and_a_few_others_in_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 3)
    monkeypatch.setattr(neardup, "LEVELS", 1)
    monkeypatch.setattr(neardup, "BLOCK", 5, raising=False)
    texts = alike(random.Random(72), kinds=1, copies=60, others=0, near=1) + alike(random.Random(72), kinds=12, copies=2, others=5)
    classes, links = expected_classes(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    found = {row["doc_id"]: row["class_id"] for row in neardup.near_duplicates(docs).collect()}
    assert links > 60 and [found[i] for i in range(len(texts))] == classes


def as_large(monkeypatch):
    """All tables count as too large to be broadcast."""
    for module in (lookup, components, neardup):
        monkeypatch.setattr(module, "measured_bytes", lambda df: 1 << 40)


@pytest.mark.parametrize("large", [False, True])
def test_buckets_with_few_open_pairs_are_not_parted(spark, monkeypatch, large):
    parted = []
    monkeypatch.setattr(neardup, "_parted", lambda rows, old=neardup._parted: parted.append(1) or old(rows))
    if large:
        as_large(monkeypatch)
    texts = alike(random.Random(71), kinds=150, copies=1, others=60)
    classes, links = expected_classes(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    found = {row["doc_id"]: row["class_id"] for row in neardup.near_duplicates(docs).collect()}
    assert links >= 140 and not parted
    assert [found[i] for i in range(len(texts))] == classes


@pytest.mark.parametrize("large", [False, True])
def test_components_write_few_tables(spark, monkeypatch, large):
    written = []
    monkeypatch.setattr(components, "materialise", lambda df, old=components.materialise: written.append(1) or old(df))
    if large:
        as_large(monkeypatch)
    stars = spark.createDataFrame([(i, i % 3) for i in range(3, 30)], "a long, b long")
    found = {row["node"]: row["root"] for row in components.components(stars).collect()}
    assert found == {i: i % 3 for i in range(30)} and len(written) == 1
    chains = spark.createDataFrame([(i, i + 1) for i in range(39) if i != 19] + [(7, 7), (5, 4), (5, 4)], "a long, b long")
    found = {row["node"]: row["root"] for row in components.components(chains).collect()}
    assert found == {i: i // 20 * 20 for i in range(40)}
