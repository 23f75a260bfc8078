"""Brute force, awkward rows and properties of the operators on small tables."""

import hashlib
import random
from collections import Counter
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import (
    components, fingerprints, html, language, mixing, neardup, packing, quality, secrets, sharding, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size int"
LONG = "word " * 40_000 + "end"


def docs_of(spark, texts, sources=None):
    rows = [(i, text, "en", (sources or ["s"])[i % len(sources or ["s"])], None if text is None else len(text), "k", 1)
            for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows, columns whose names clash with the operators' own."""
    rows = [(1, "a b", "en", "x", 3, "k", 1), (1, "a b", "en", "x", 3, "k", 1), (2, None, None, None, None, None, None),
            (None, "a b", "en", "x", 3, "k", 1), (None, None, None, None, None, None, None), (3, "", "en", "y", 0, "k", 1),
            (4, LONG, "en", "y", len(LONG), "k", 1), (5, "é\U0001f600 x", "fr", "x", 4, "k", 1), (6, " \n ", "en", "", 3, "k", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(chance, number, vocabulary=500):
    return " ".join(f"w{chance.randrange(vocabulary)}" for _ in range(number))


# sharding

def test_best_fit_decreasing_places_every_item_in_the_tightest_bin():
    chance = random.Random(1)
    items = [chance.randint(1, 60) for _ in range(400)]
    classes = [(size, items.count(size)) for size in set(items)]
    left, expected = [], []
    for size in sorted(items, reverse=True):
        fitting = [i for i, rest in enumerate(left) if rest >= size]
        if not fitting:
            left.append(100)
            fitting = [len(left) - 1]
        best = min(fitting, key=lambda i: (left[i], i))
        left[best] -= size
        expected.append((size, best))
    runs = sharding.best_fit_decreasing(classes, 100)
    found = []
    for i, (size, first, bin_) in enumerate(runs):
        later = [run[1] for run in runs[i + 1:] if run[0] == size][:1]
        found += [(size, bin_)] * ((later[0] if later else dict(classes)[size]) - first)
    assert sorted(found) == sorted(expected)


def test_shards_are_even_and_keep_equal_texts_together(spark):
    chance = random.Random(2)
    texts = [words(chance, chance.randint(1, 300)) for _ in range(400)] + ["the same text " * 20] * 60
    rows = sharding.shard_documents(docs_of(spark, texts)).toPandas()
    sums = rows.groupby("shard")["size"].sum()
    assert len(sums) == 16 and sums.max() - sums.min() <= 0.02 * sums.mean()
    assert rows[rows.doc_id >= 400].shard.nunique() == 1
    for _, own in rows.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    assert all(row.text_crc32 == zlib.crc32(texts[row.doc_id].encode()) and row.size == len(texts[row.doc_id]) + 1
               for row in rows.itertuples() if hasattr(row, "doc_id"))


def test_capacity_is_kept(spark):
    groups = spark.createDataFrame([(hashlib.md5(str(i).encode()).hexdigest(), 1 + i % 50) for i in range(300)], "key string, bytes long")
    found = sharding.shard_groups(groups, capacity=100).groupBy("shard").agg(F.sum("bytes").alias("b")).toPandas()
    assert found.b.max() <= 100 and len(found) <= -(-sum(1 + i % 50 for i in range(300)) // 100) + 2


# packing

def test_matching_and_best_fit_against_a_plain_model():
    chance = random.Random(3)
    for capacity in (12, 100):
        counts = {size: chance.randint(0, 30) for size in range(1, capacity + 1)}
        bins, ranks = {}, {}
        runs = packing.match_and_fit(counts, capacity)
        for i, (size, first, bin_, per_bin, offset) in enumerate(runs):
            end = next((run[1] for run in runs[i + 1:] if run[0] == size), counts[size])
            assert first == ranks.get(size, 0)
            ranks[size] = end
            for item in range(end - first):
                bins.setdefault(bin_ + item // per_bin, []).append((offset + item % per_bin * size, size))
        assert ranks == {size: n for size, n in counts.items() if n}
        for items in bins.values():
            items.sort()
            assert [offset for offset, _ in items] == list(np.cumsum([0] + [size for _, size in items[:-1]]))
            assert sum(size for _, size in items) <= capacity
            assert sum(3 * size > capacity for _, size in items) <= 2
        plain = sharding.best_fit_decreasing(list(counts.items()), capacity)
        assert len(bins) <= max(bin_ for *_, bin_ in plain) + 2


@pytest.mark.parametrize("text", [
    "", " ", "  a  b ", "\na \n b", "it's  don't 'll x'd", "é ü ñ²³½ Ⅷ", "日本 語 テ",
    "a b   c", "<|endoftext|> x", "1234 56 a1b2 ?!... \t\t x", "trailing ", "ſecret K", "x\x1c y \x85 z"])
def test_cached_token_ids_equal_the_tokenizers(text):
    import public_tokenizers
    encoder = packing.token_ids(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert encoder.of(text) == encoder.of(text) == encoder._encode(text)


def test_token_ids_of_whole_texts_equal_the_tokenizers():
    import random

    import public_tokenizers
    encoder = packing.token_ids(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    chance = random.Random(5)
    common = [chr(i) for i in (10, 32, *range(33, 127), *range(0xA1, 0x530))]
    tricky = ["\n", " ", " ", "a", "b", "1", "'s", "'ll", "!", "é", "Ж", "\u0308", "²", "½", "\u00ad", "ǅ", "\u0378", "\u2019", "\xa0", "\x1c", "<|"]
    for number in range(4_000):
        text = "".join(chance.choices(tricky if number % 2 else common, k=chance.randrange(40)))
        assert encoder.of(text) == encoder._encode(text)
    for text in ("w" * 100_000, "ab1 " * 50_000, "\n \n" * 20, "\n \n" * 30_000, "!?" * 50_000, "a <|endoftext|> b"):
        assert encoder.of(text) == encoder._encode(text)


def test_packing_awkward_rows(spark, awkward, empty):
    rows = packing.pack_documents(awkward).toPandas()
    assert rows.groupby("sequence_id").length.sum().max() <= 2048
    assert set(rows[rows.doc_id == 2].length) == {1}
    assert rows[rows.doc_id == 4].length.iloc[1:].eq(2048).all()
    assert packing.pack_documents(empty).count() == 0


# mixing

def test_mix_follows_the_targets(spark, awkward, empty):
    chance = random.Random(4)
    texts = [words(chance, chance.randint(1, 60)) for _ in range(600)]
    docs = docs_of(spark, texts, ["a", "b", "c", None])
    rows = mixing.materialise(docs.select(
        mixing.hashed_key(F.col("doc_id")).alias("key"), "source", mixing.word_count(F.col("text")).alias("size")))
    found = mixing.fair_queue(rows).toPandas()
    assert (found.taken <= 3 * found["size"]).all()
    by_source = found.groupby(found.source.fillna("~")).agg(target=("target", "first"), taken=("taken", "sum"))
    assert (abs(by_source.target - by_source.taken) <= 130).all()
    assert abs(by_source.target.sum() - found["size"].sum()) < 1
    again = mixing.fair_queue(rows).toPandas()
    assert sorted(zip(found.key, found.taken)) == sorted(zip(again.key, again.taken))
    assert mixing.mix(awkward).columns == awkward.columns
    assert mixing.mix(empty).count() == 0


# fingerprints

def test_order_min_hash_against_a_plain_model():
    chance = random.Random(5)
    for text in ("ab", "x" * 40, words(chance, 30), words(chance, 400, 5), words(chance, 2000)):
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        seen, ring = {}, []
        for place, value in enumerate(fingerprints.kmer_hashes(codes).tolist()):
            number = seen[value] = seen.get(value, -1) + 1
            if number:
                value = int(fingerprints.mixed(np.array([(value + number * int(fingerprints._GOLDEN)) % 2 ** 64], np.uint64))[0])
            ring.append((value, place))
        expected = ""
        for start in fingerprints._STARTS.tolist():
            chosen = sorted(ring, key=lambda entry: (entry[0] - start) % 2 ** 64)[:fingerprints.TUPLE]
            value = np.zeros(1, np.uint64)
            for entry, _ in sorted(chosen, key=lambda entry: entry[1]):
                value = fingerprints.mixed(value * np.uint64(5) + np.uint64(entry))
            expected += f"{int(value[0]) >> 48:04x}"
        assert fingerprints.fingerprint(text) == expected


def test_order_of_text_matters():
    chance = random.Random(6)
    one, two = words(chance, 200), words(chance, 200)
    assert fingerprints.likeness(fingerprints.fingerprint(one + two), fingerprints.fingerprint(two + one)) < 0.8
    assert fingerprints.fingerprint("") == "0" * 256


def test_next_documents_across_ranges(spark, awkward, empty):
    chance = random.Random(7)
    texts = [words(chance, chance.randint(0, 40)) for _ in range(60)]
    found = {row["doc_id"]: row for row in fingerprints.compare_with_next(docs_of(spark, texts)).collect()}
    assert len(found) == 60
    for i, text in enumerate(texts):
        following = texts[i - 1] if i else texts[-1]
        third = len(text) // 3
        changed = text[:len(text) - third] + following[:third]
        row = found[i]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert row["edited_fingerprint"] == fingerprints.fingerprint(changed)
        assert row["near_next"] == fingerprints.likeness(fingerprints.fingerprint(text), fingerprints.fingerprint(following))
    assert fingerprints.compare_with_next(awkward).count() == awkward.count()
    assert fingerprints.compare_with_next(awkward.filter("doc_id is null")).count() == 2
    assert fingerprints.compare_with_next(empty).count() == 0


# quality

def test_base_counts_against_a_plain_model():
    chance = random.Random(8)
    for text in (None, "", "a", "a b c a b c", "a a a a", "x # y\n \nx # y\n", "é b |$\x0bq", words(chance, 300, 6)):
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        windows = [tuple(own[i:i + 3]) for i in range(len(own) - 2)]
        covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
        assert quality.base_counts(text) == (
            len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_compression_bands(spark, awkward, empty):
    chance = random.Random(9)
    good = [" ".join(chance.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma"]) + str(chance.randrange(90))
                     for _ in range(chance.randint(100, 900))) for _ in range(300)]
    docs = docs_of(spark, good)
    limits = quality.fit_limits(docs, docs.select("doc_id"))
    noise = " ".join("".join(chance.choice("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(9)) for _ in range(300))
    repeated = " ".join(f"line {i % 7} of it" for i in range(400))
    found = quality.quality_rules(docs_of(spark, [*good, noise, repeated, None, "few words"]), limits).toPandas().set_index("doc_id")
    assert found.kept[:300].mean() > 0.98 and not found.kept[300:].any()
    assert quality.quality_rules(awkward, {}).count() == awkward.count()
    assert quality.quality_rules(empty, quality.fit_limits(empty, empty)).count() == 0


# toxicity

def test_toxicity_is_learnt_and_held_out(spark, awkward, empty):
    chance = random.Random(10)
    plain = [f"{a}{b}{c}" for a in ("th", "er", "on", "an", "re") for b in ("ab", "ed", "ing", "or", "is") for c in ("a", "en", "us", "ly")]
    bad = ["idiotic", "worthless", "pathetic", "garbage"]
    toxic = [i % 4 == 0 for i in range(900)]
    texts = [" ".join(chance.choice(bad) if t and chance.random() < 0.1 else chance.choice(plain) for _ in range(120)) for t in toxic]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    rows = toxicity.score_texts(docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "text"), model).toPandas()
    own = rows[rows.held_out]
    assert set(own.doc_id) == {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert (own.predicted == own.doc_id.map(lambda i: int(toxic[i]))).mean() > 0.95
    scored = toxicity.score_texts(awkward.select("doc_id", "text"), model).toPandas()
    assert len(scored) == awkward.count() and scored.score.between(0, 1).all()
    nothing = toxicity.fit(empty, labels.limit(0))
    assert toxicity.score_texts(awkward.select("doc_id", "text"), nothing).count() == awkward.count()


# language

def test_language_of_pages_and_documents(spark, awkward, empty):
    chance = random.Random(11)
    syllables = {"en": ["the", "ing", "th", "wh", "ed"], "fr": ["eau", "é", "oi", "que", "aux"], "de": ["sch", "ung", "ei", "ß", "pf"]}
    make = lambda lang, n: " ".join("".join(chance.choice(syllables[lang]) for _ in range(chance.randint(1, 3))) for _ in range(n))
    rows = [(i, make(lang, 30), lang, f"s{i % 3}") for i, lang in enumerate(["en", "fr", "de"] * 60)]
    docs = spark.createDataFrame([*rows, (900, "12 345 !", "en", "s1"), (901, None, None, None), (902, "ξψω ξψ ωω ψψξ", "en", "s1")],
                                 "doc_id long, text string, lang string, source string")
    model = language.train(docs.filter("doc_id < 200"))
    found = language.document_languages(docs, model).toPandas().set_index("doc_id")
    assert all(found.language[i] == lang for i, _, lang, _ in rows)
    assert set(found.language[[900, 901, 902]]) == {"und"}
    assert language.keep_identified(docs, model).count() == 180
    pages = spark.createDataFrame(
        [(i, f"https://h{i % 2}.example.org/x", f'<html lang="{lang}"><nav>{make("de", 5)}</nav><article><p>{make(lang, 20)}</p></article>')
         for i, lang in enumerate(["en", "fr"] * 10)] + [(90, None, None), (91, "", "<p>1</p>")], "page_id long, url string, html string")
    by_page = language.page_languages(pages, model).toPandas().set_index("page_id")
    assert [by_page.language[i] for i in range(20)] == ["en", "fr"] * 10
    assert by_page.declared[0] == "en" and set(by_page.language[[90, 91]]) == {"und"}
    assert language.document_languages(awkward, model).count() == awkward.count()
    assert language.document_languages(awkward, language.train(empty)).filter("language = 'und'").count() == awkward.count()
    assert language.document_languages(empty, model).count() == 0


def test_a_host_decides_where_the_text_cannot(spark):
    texts = [(i, "abab abab", "fr", "h1") for i in range(20)] + [(50, "cdcd cdcd", "en", "h2")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string")
    model = language.TextModel(("en", "fr"), np.full((language.BUCKETS, 2), -5.0, np.float32))
    model.logs[language.trigrams("abab"), 1] += 2
    doubtful = spark.createDataFrame([(99, "efef efef", None, "h1")], docs.schema)
    found = language.document_languages(docs.unionByName(doubtful), model).filter("doc_id = 99").first()
    assert found["language"] == "fr" and found["probability"] > 0.8


# secrets

def test_base_spans_and_ownership(spark, awkward, empty):
    copied, own = "AKIA" + "EXAMPLECOPIED01234", "ghp_" + "a1B2c3D4e5F6g7H8i9J0"
    texts = [f"x password = '{'Ab1' * 6}' {own}", *[f"see {copied} and token: short; Secret:deadbeefdeadbeef00 {i}" for i in range(30)],
             "xox" + "b-Zq9Wk3Lm7Pt2Rv8Xy", None, ""]
    docs = docs_of(spark, texts, [f"o{i}" for i in range(7)])
    found = secrets.find_secrets(docs).toPandas().set_index("doc_id")
    patterns = [(re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I), 2, 12, "assign"),
                (re.compile(r"AKIA[A-Z0-9]+"), 0, 18, "access"), (re.compile(r"[0-9a-f]+"), 0, 16, "hex")]
    for i, text in enumerate(texts):
        spans = sorted((m.start(), k, m.end(), kind) for k, (p, g, least, kind) in enumerate(patterns)
                       for m in p.finditer(text or "") if len(m[g]) >= least)
        shown = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)
        assert found.base_sha256[i] == hashlib.sha256(shown.encode()).hexdigest()
        assert set(filter(None, shown.split(","))) <= set(found.spans[i].split(","))
    assert "prefixed" in found.spans[0] and "prefixed" in found.spans[31]
    assert found.n_examples[5] >= 1 and found.n_live[0] == 1
    clean = {row["doc_id"]: row for row in secrets.redact(docs).collect()}
    assert own not in clean[0]["text"] and clean[0]["n_chars"] == len(clean[0]["text"])
    assert copied in clean[3]["text"]  # seven owners have it: an example, which stays in the text and in ``spans``
    assert clean[32]["text"] is None and len(clean) == len(texts)
    assert secrets.redact(awkward).columns == awkward.columns and secrets.redact(awkward).count() == awkward.count()
    assert secrets.find_secrets(empty).count() == 0


# pages

def test_structure_and_repeats(spark):
    page = ('<html><head><title>t</title><style>p{}</style></head><body class="no-sidebar"><header>top</header><nav>menu</nav>'
            '<form><article class="post"><header><h1>A &amp; B</h1></header><p>one<b>two</b>  three<br>four<p>five'
            '<div class="ad banner">buy</div><ul><li>x<li>y</ul></article></form><div class="cookie-notice">ok</div>'
            '<section id="comments"><article class="comment">no</article></section><aside>side</aside><footer>&copy; z')
    assert [text for zone, text in html.blocks(page) if zone == html.ARTICLE] == ["A & B", "onetwo three four", "five", "x", "y"]
    assert not [text for zone, text in html.blocks(page) if zone == html.OPEN]
    frame = "<div>welcome to our site please read on carefully every day</div>"
    rows = [(i, f"http://h.example/{i}", f"{frame}<p>story number {i} tells of {'abcdefgh'[i]}</p>") for i in range(5)]
    rows += [(10, None, None), (11, "", ""), (12, "x", "<p>cut <b"), (13, "http://other.example", frame)]
    found = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).toPandas().set_index("page_id")
    assert [found.text[i] for i in range(5)] == [f"story number {i} tells of {'abcdefgh'[i]}" for i in range(5)]
    assert found.text[10] == "" and found.n_chars[11] == 0 and found.text[12] == "cut" and found.text[13].startswith("welcome")
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.main_text(none).count() == 0


# near duplicates

def near_copies(chance):
    base = [words(chance, 120, 5000) for _ in range(6)]
    texts = []
    for text in base:
        texts.append(text)
        for _ in range(8):
            own = text.split()
            for _ in range(chance.choice([0, 1, 2, 4, 9])):
                own[chance.randrange(len(own))] = f"n{chance.randrange(10 ** 6)}"
            texts.append(" ".join(own))
    return [*texts, *texts[:5], "one two", "one two", "one two three", "", None, " ", words(chance, 3000), None]


def plain_likeness(x, y):
    """The sum, over common shingles i, of 1 / sum over all j of max(x_j / x_i, y_j / y_i)."""
    keys = sorted(x.keys() | y.keys())
    one, other = (np.array([side.get(key, 0.0) for key in keys]) for side in (x, y))
    both = np.flatnonzero((one > 0) & (other > 0))
    return sum(1 / np.maximum(one / one[i], other / other[i]).sum() for i in both)


def plain_weights(text):
    words_ = (text or "").lower().split()
    size = min(neardup.WORDS, len(words_))
    counts = Counter(tuple(words_[i:i + size]) for i in range(len(words_) - size + 1)) if words_ else {}
    return {shingle: 1 + np.log2(n) / neardup.DAMPING for shingle, n in counts.items()}


def links_by_brute_force(texts):
    weights = [plain_weights(text) for text in texts]
    return [(j, i) for i in range(len(texts)) for j in range(i)
            if (texts[i] or "") == (texts[j] or "")
            or len(weights[i].keys() & weights[j].keys()) > 0.6 * max(len(weights[i]), len(weights[j]))
            and plain_likeness(weights[i], weights[j]) >= 0.8]


def classes_by_brute_force(texts):
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for j, i in links_by_brute_force(texts):
        parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("small", [32, 4])
def test_near_duplicates_against_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(neardup, "SMALL", small)
    texts = near_copies(random.Random(12))
    found = {row["doc_id"]: row for row in neardup.near_duplicates(docs_of(spark, texts)).collect()}
    expected = classes_by_brute_force(texts)
    assert [found[i]["class_id"] for i in range(len(texts))] == expected
    assert [found[i]["class_size"] for i in range(len(texts))] == [expected.count(c) for c in expected]
    kept = neardup.drop_near_duplicates(docs_of(spark, texts))
    assert sorted(row["doc_id"] for row in kept.collect()) == sorted(set(expected))


def test_recall_in_a_large_group_of_texts_more_and_less_alike(spark):
    chance = random.Random(31)
    base, texts = words(chance, 90).split(), []
    for _ in range(150):  # from nearly equal texts to some that resemble none or one of the others
        own = list(base)
        for _ in range(chance.choice([0, 1, 1, 2, 2, 3, 4, 5, 6, 8])):
            own[chance.randrange(len(own))] = f"n{chance.randrange(10 ** 6)}"
        texts.append(" ".join(own))
    found = {row["doc_id"]: row["class_id"] for row in neardup.near_duplicates(docs_of(spark, texts)).collect()}
    links = [(i, j) for i, j in links_by_brute_force(texts) if texts[i] != texts[j]]
    assert len(links) > 200 and sum(found[i] == found[j] for i, j in links) >= 0.98 * len(links)
    expected = classes_by_brute_force(texts)
    assert all(expected[i] == expected[found[i]] for i in range(len(texts)))  # nothing else is linked


def test_likeness_of_pairs_and_sketches():
    chance = np.random.default_rng(17)
    for _ in range(40):
        elements = np.unique(chance.integers(0, 2 ** 63, 60, dtype=np.uint64))
        a, b = (np.sort(chance.choice(elements, 40, replace=False)) for _ in range(2))
        x, y = (neardup.weights_of(chance.choice([1, 1, 2, 9, 40], 40)) for _ in range(2))
        expected = plain_likeness(dict(zip(a.tolist(), x)), dict(zip(b.tolist(), y)))
        assert neardup.probability_jaccard(a, x, b, y) == pytest.approx(expected)
    found = chance.integers(0, 2 ** 63, (2, neardup.REGISTERS), dtype=np.uint64)
    found[1, :50] = found[0, :50]
    one, other = neardup.sketches(found)
    differ = sum(bin(int(v)).count("1") for v in ((x | x >> 1 | x >> 2 | x >> 3) & 0x1111111111111111 for x in map(int, one ^ other)))
    assert 8 <= differ <= 14


def test_sketches_are_compared_register_by_register(spark):
    pairs = spark.createDataFrame([([0, 0, 0, 0], [0, 0, 0, 0]), ([-1, 0, 1, 0x80], [0, 0, 0, 0x10])], "a array<long>, b array<long>")
    assert [row[0] for row in pairs.select(neardup.unlike(F.col("a"), F.col("b"))).collect()] == [0, 16 + 1 + 1]


def test_near_duplicates_of_awkward_rows(spark, awkward, empty):
    found = neardup.near_duplicates(awkward).toPandas()
    assert len(found) == awkward.count() and found[found.doc_id == 1].class_id.eq(1).all()
    kept = neardup.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns and kept.filter("text = 'a b'").count() == 1
    assert neardup.near_duplicates(empty).count() == 0 and neardup.drop_near_duplicates(empty).count() == 0


def test_signatures_estimate_probability_jaccard():
    chance = np.random.default_rng(13)
    shared, own = chance.integers(0, 2 ** 63, 300, dtype=np.uint64), chance.integers(0, 2 ** 63, (2, 100), dtype=np.uint64)
    agreed = []
    for shift in range(30):
        elements = np.concatenate([np.concatenate([shared + np.uint64(shift), own[i] + np.uint64(shift)]) for i in (0, 1)])
        found = neardup.signatures(elements, np.ones(800), np.array([0, 400, 800]))
        agreed.append((found[0] == found[1]).mean())
    assert abs(np.mean(agreed) - 300 / 500) < 0.05


def test_components(spark):
    chance = random.Random(14)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [
        (chance.randrange(200, 260), chance.randrange(200, 260)) for _ in range(40)]
    found = {row["node"]: row["root"] for row in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {n: n for edge in edges for n in edge if edge[0] != edge[1]}
    for _ in range(300):
        for a, b in edges:
            if a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == parent
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
