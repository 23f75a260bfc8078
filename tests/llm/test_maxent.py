"""The language model: counts against plain Python, gradients against differences, probabilities that sum to one."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import maxent
from tillroll.llm.queries import QUERIES
from tillroll.llm.tables import table

SF = "/root/testdata/sf0.001"


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def plain(rows):
    """(id, held out, tokens, known, N, base score) of each row."""
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(word for i, text in rows if not held(i) for word in words_of(text))
    total = sum(counts.values())
    return [(i, held(i), len(words_of(text)), sum(word in counts for word in words_of(text)), total,
             sum(math.log10((counts[word] + 1) / (total + len(counts) + 1)) for word in words_of(text)))
            for i, text in rows]


def same(found, expected):
    order = lambda row: (row[0] is None, row[0] or 0, row[2:])
    found, expected = sorted(map(tuple, found), key=order), sorted(expected, key=order)
    assert [row[:5] for row in found] == [row[:5] for row in expected]
    assert [row[5] for row in found] == pytest.approx([row[5] for row in expected], rel=1e-9)
    return found


def random_model(seed=0):
    chance = np.random.default_rng(seed)
    ids = chance.integers(-2**62, 2**62, maxent.FREQUENT + 400)
    counts = chance.integers(1, 50, len(ids))
    frequent = list(zip(ids[:maxent.FREQUENT].tolist(), counts[:maxent.FREQUENT].tolist()))
    rare, n = ids[maxent.FREQUENT:], counts[maxent.FREQUENT:]
    suffixes = [(s, int(n[rare % maxent.SUFFIXES == s].sum()), int((rare % maxent.SUFFIXES == s).sum())) for s in range(maxent.SUFFIXES)]
    model = maxent.new_model(frequent, suffixes, int(counts.sum()), len(ids))
    model.weights += chance.normal(scale=0.3, size=model.weights.shape).astype(np.float32)
    return model, ids, counts


def test_probabilities_of_all_words_sum_to_one():
    model, ids, counts = random_model()
    outcomes, own = model.outcomes(ids)
    assert own.sum() == maxent.FREQUENT and len(set(outcomes[own])) == maxent.FREQUENT
    within = np.exp(model.within(ids, counts, own))
    before = np.array([5, 900, 17])
    chances = np.empty(maxent.OUTCOMES)
    for outcome in range(maxent.OUTCOMES):
        text = np.append(before, outcome)
        chances[outcome] = np.exp(maxent.log_probabilities(model, text, np.array([0])))[-1]
    assert chances.sum() == pytest.approx(1, abs=1e-4)
    # Words share what their outcome has, but for the part of the unknown words.
    unknown = np.zeros(maxent.OUTCOMES)
    unknown[model.suffix_slots] = 1 / model.suffix_totals
    assert (chances[outcomes] * within).sum() + (chances * unknown).sum() == pytest.approx(1, abs=1e-4)


def test_gradient_equals_differences():
    model, _, _ = random_model(1)
    chance = np.random.default_rng(2)
    outcomes, starts = chance.integers(0, maxent.OUTCOMES, 60), np.array([0, 20, 21])
    rows = maxent.features(outcomes, starts)
    classes, members = np.divmod(outcomes, maxent.MEMBERS)
    assert (rows[0][starts] == 1 + maxent.START).all() and rows.max() < maxent.CLASS_ROWS
    for first, rows, targets in ((0, rows, classes),
                                 (maxent.CLASS_ROWS + classes, maxent.member_rows(rows, classes), members)):
        assert rows.max() < maxent.ROWS
        weights = model.weights.astype(np.float64)
        value = lambda: maxent._log_softmax_at(weights, first, rows, targets).sum()
        found, sums, tokens = maxent.gradient(weights, first, rows, targets)
        assert tokens.sum() == rows.size + len(targets) and len(set(found)) == len(found)
        for at in chance.integers(0, len(found), 15):
            column, start = chance.integers(maxent.CLASSES), value()
            weights[found[at], column] += 1e-5
            assert (value() - start) / 1e-5 == pytest.approx(sums[at, column], abs=1e-3)
            weights[found[at], column] -= 1e-5


def test_sums_by_row_equal_one_by_one():
    chance = np.random.default_rng(3)
    for size, numbers in ((1, 1), (5, 2), (700, 1), (700, 3), (700, 500), (3_000, 40)):
        rows, values = chance.integers(0, numbers, (4, size)), chance.normal(size=(size, maxent.CLASSES))
        found, sums, times = maxent._summed(rows, values)
        expected = np.zeros((numbers, maxent.CLASSES))
        np.add.at(expected, rows.ravel(), np.tile(values, (4, 1)))
        assert sorted(found) == np.unique(rows).tolist() and (times == np.bincount(rows.ravel())[found]).all()
        assert np.allclose(sums, expected[found])


def test_steps_have_the_features_of_whole_texts():
    outcomes = np.random.default_rng(4).integers(0, maxent.OUTCOMES, 3 * maxent.STEP_TOKENS + 5)
    for starts in ([0], [0, 1, 2, maxent.STEP_TOKENS - 2, maxent.STEP_TOKENS + 1, 2 * maxent.STEP_TOKENS, len(outcomes) - 1]):
        steps = list(maxent._steps(outcomes, np.array(starts)))
        assert (np.concatenate([rows for _, rows in steps], 1) == maxent.features(outcomes, np.array(starts))).all()
        assert len(steps) == 4 and all(rows.shape[1] == len(outcomes[part]) for part, rows in steps)


def test_great_weights_stay_finite():
    model, _, _ = random_model()
    model.weights *= 1_000
    found = maxent.log_probabilities(model, np.arange(maxent.OUTCOMES), np.array([0]))
    assert np.isfinite(found).all() and (found <= 1e-4).all()


def test_tokens_of_a_block_come_back():
    texts = ["a b a", None, "x " * 70_000, " ".join(map(str, range(70_000)))]
    block = maxent._Block()
    for number, text in enumerate(texts):
        block.add(number, number % 2 == 1, text)
    ids, held, lengths, vocabulary, learnt, packed = block.columns()
    expected = maxent.word_ids([word for text in texts for word in maxent.tokens_of(text)]).tolist()
    assert vocabulary[maxent._unpacked(packed)].tolist() == expected and len(set(vocabulary)) == len(vocabulary)
    assert lengths.tolist() == [4, 1, 70_001, 70_001] and held == [False, True, False, True] and ids == [0, 1, 2, 3]
    assert dict(zip(vocabulary.tolist(), learnt.tolist()))[maxent.word_ids([b"x"])[0]] == 70_000
    assert learnt.sum() == 4 + 70_001


AWKWARD = [
    (1, None), (2, ""), (3, " \t\n"), (None, "A b\x0bC"), (4, "ÀÉ àé İ ß"), (5, "the the THE tHe"), (5, "the the THE tHe"),
    (6, "w" * 100_000), (7, "word " * 120_000), (8, "a b a b"), *[(i, "the cat sat on the mat .") for i in range(9, 60)]]


def test_awkward_rows_equal_plain_counts(spark):
    docs = spark.createDataFrame(AWKWARD, "doc_id long, text string").withColumns({
        "score": F.lit(1), "held_out": F.lit("x"), "block": F.lit(2), "id": F.lit(3)})
    found = same(maxent.score_texts(docs.repartition(5)).collect(), plain(AWKWARD))
    assert all(row[6] < 0 and math.isfinite(row[6]) for row in found)
    assert maxent.score_texts(docs.limit(0)).count() == 0


def test_nothing_to_learn_from(spark):
    held = [(str(i), "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    found = maxent.score_texts(spark.createDataFrame(held, "name string, body string"), "body", "name").collect()
    assert {row["train_tokens"] for row in found} == {0} and {row["base_score"] for row in found} == {0}
    assert len({row["score"] for row in found}) == 1 and math.isfinite(found[0]["score"])


def test_query_equals_plain_counts_and_learns_contexts(spark):
    rows = [tuple(row) for row in table(spark, SF, "documents").select("doc_id", "text").collect()]
    first = QUERIES["op13_lm_scoring"](spark, SF).collect()
    found = same(first, plain(rows))
    held = [row for row in found if row[1]]
    assert sum(row[6] for row in held) > sum(row[5] for row in held)  # unseen texts are likelier than by counts
    assert sorted(map(tuple, QUERIES["op13_lm_scoring"](spark, SF).collect())) == sorted(map(tuple, first))


def test_order_of_words_matters(spark):
    docs = [(i, "one two three four five six seven eight " * 5) for i in range(300)]
    docs += [(1_000 + i, "eight three one seven two six four five " * 5) for i in range(2)]
    found = maxent.score_texts(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    known = [row for row in found if row["doc_id"] < 1_000]
    strange = [row for row in found if row["doc_id"] >= 1_000]
    assert min(row["score"] for row in known) > max(row["score"] for row in strange) + 5
