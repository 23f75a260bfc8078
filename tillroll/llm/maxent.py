"""Operator 13: texts scored by a hashed maximum-entropy model with a class-factored softmax.

A word is predicted in three steps: its class, its outcome within the class, and itself within the outcome. The most
frequent words are outcomes of their own; all others share outcomes by a hash of their last letters, within which
they follow their counts. The softmax layers sum weights of features of the words before: of a bigram, a hashed trigram
and two skips for the class, and hashed with the class of a bigram and a skip for the outcome.

Texts become blocks of numbered words once. Counts are grouped over all blocks; each block gets back the counts of
its own words only, so no task and not the driver needs to hold the vocabulary. The model's size is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.tables import share_code, table, written

END = b"\n"                 # the last token of each text; no word can be the same
SUFFIX_BYTES = 3            # letters by which rare words share an outcome
SUFFIXES = 512              # outcomes of rare words
FREQUENT = 512              # words that are outcomes of their own
CLASSES = 32
OUTCOMES = SUFFIXES + FREQUENT
MEMBERS = OUTCOMES // CLASSES
START = OUTCOMES            # what stands before a text
TRIGRAMS = 1 << 12          # rows that hashed trigrams share
CLASS_ROWS = 1 + 3 * (OUTCOMES + 1) + TRIGRAMS
MEMBER_ROWS = CLASSES + (1 << 14)  # a row per class, then hashed pairs of feature and class
ROWS = CLASS_ROWS + MEMBER_ROWS
BLOCK_TOKENS = 1 << 20
ROUNDS = 3                  # shares of each block's texts, one after the other; the model is averaged after each
STEP_TOKENS = 1 << 14
CACHED_TOKENS = 1 << 11     # tokens whose sums stay near the processor
GREATEST_SUM = 80.0         # sums of weights are held within plus and minus this, whose exponentials float32 can add
SELDOM = 64                 # rows with no more tokens in a step are summed side by side
RATE = 0.25
SCALE = 1 << 16             # weights travel as whole numbers, whose sums do not depend on their order
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    """Words by the order in which they first came."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def word_ids(words: list[bytes]) -> np.ndarray:
    """64 bits for each word, whose lowest tell the outcome that it would share as a rare one."""
    whole = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    suffix = np.fromiter((xxhash.xxh3_64_intdigest(word[-SUFFIX_BYTES:]) for word in words), np.uint64, len(words))
    few = np.uint64(SUFFIXES)
    return (whole // few * few + suffix % few).view(np.int64)


def tokens_of(text: str | None) -> list[bytes]:
    """A text's words in lower case (A to Z only), then the end."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    words.append(END)
    return words


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers by their bytes' places, which compresses well as most are small."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class _Block:
    """Texts whose tokens are numbered within the block, by their frequency in the end."""

    def __init__(self) -> None:
        self.ids: list = []
        self.held: list[bool] = []
        self.texts: list[np.ndarray] = []
        self.numbers = _Numbers()
        self.tokens = 0

    def add(self, doc_id, held: bool, text: str | None) -> None:
        words = tokens_of(text)
        self.ids.append(doc_id)
        self.held.append(held)
        self.texts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.tokens += len(words)

    def columns(self) -> tuple:
        """Ids, held out, lengths, vocabulary, tokens learnt from by word, tokens."""
        lengths = np.array([len(text) for text in self.texts], np.int32)
        numbers = np.concatenate(self.texts)
        order = np.argsort(-np.bincount(numbers), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        numbers = rank[numbers]
        vocabulary = word_ids(list(self.numbers))[order]
        learnt = numbers[np.repeat(~np.array(self.held, bool), lengths)]
        return self.ids, self.held, lengths, vocabulary, np.bincount(learnt, minlength=len(vocabulary)), _packed(numbers)


def _blocks_of(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId() << 32, 0
    block = _Block()

    def taken() -> pa.RecordBatch:
        nonlocal number, block
        values = [part + number, *block.columns()]
        number, block = number + 1, _Block()
        return pa.RecordBatch.from_arrays(
            [pa.array([value], field.type) for value, field in zip(values, schema, strict=True)], schema=schema)

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            block.add(*row)
            if block.tokens >= BLOCK_TOKENS:
                yield taken()
    if block.ids:
        yield taken()


def token_blocks(docs: DataFrame) -> DataFrame:
    """``docs`` (id, is_held_out, text, in this order) as a written table of blocks of ``BLOCK_TOKENS`` tokens or more.

    A block has its texts' ids, lengths, and tokens as numbers in its own vocabulary, with what the texts that are
    learnt from count of each word. A text is never divided.
    """
    kind = docs.schema[0].dataType.simpleString()
    schema = (f"block long, ids array<{kind}>, held array<boolean>, lengths array<int>, vocabulary array<long>, "
              "learnt array<int>, tokens binary")
    return written(_mapped(docs, _blocks_of, schema))


def _mapped(df: DataFrame, step, schema: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    share_code(df.sparkSession)
    target = to_arrow_schema(_parse_datatype_string(schema))
    return df.mapInArrow(lambda batches: step(batches, target), schema)


@dataclass
class Model:
    """Weights, and what the counts tell about outcomes. ``counts``, ``words``: tokens and distinct words learnt from."""

    frequent: np.ndarray           # ids of the words that are outcomes, sorted
    slots: np.ndarray              # their outcomes
    frequent_counts: np.ndarray
    suffix_slots: np.ndarray       # the outcome of each suffix
    suffix_totals: np.ndarray      # tokens plus distinct words plus one, of the rare words of each suffix
    counts: int
    words: int
    weights: np.ndarray = field(repr=False)  # ROWS x CLASSES

    def outcomes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The outcomes of words, and which are outcomes of their own."""
        if not len(self.frequent):
            return self.suffix_slots[ids % SUFFIXES], np.zeros(len(ids), bool)
        at = np.minimum(np.searchsorted(self.frequent, ids), len(self.frequent) - 1)
        own = self.frequent[at] == ids
        return np.where(own, self.slots[at], self.suffix_slots[ids % SUFFIXES]), own

    def within(self, ids: np.ndarray, counts: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The logarithm of a word's probability within its outcome; one more stands for all unknown words."""
        shared = np.log((counts + 1.0) / self.suffix_totals[ids % SUFFIXES])
        return np.where(own, 0.0, shared)


def new_model(frequent: list[tuple[int, int]], suffixes: list[tuple[int, int, int]], counts: int, words: int) -> Model:
    """A model that gives each outcome its share of the tokens. ``frequent``: (id, tokens) of the most frequent words;
    ``suffixes``: (suffix, tokens, distinct words) of all others."""
    tokens, distinct = np.zeros(SUFFIXES, np.int64), np.zeros(SUFFIXES, np.int64)
    for suffix, total, number in suffixes:
        tokens[suffix], distinct[suffix] = total, number
    ids, own = (np.array([pair[i] for pair in frequent], np.int64) for i in range(2))
    mass = np.concatenate([own, np.zeros(FREQUENT - len(own)), tokens + distinct]) + 1.0
    by_mass = np.argsort(-mass, kind="stable")
    slot = np.empty(OUTCOMES, np.int64)
    slot[by_mass] = np.arange(OUTCOMES)
    classes = mass[by_mass].reshape(CLASSES, MEMBERS)
    weights = np.zeros((ROWS, CLASSES), np.float32)
    weights[0] = np.log(classes.sum(1) / mass.sum())
    weights[CLASS_ROWS:CLASS_ROWS + CLASSES, :MEMBERS] = np.log(classes / classes.sum(1, keepdims=True))
    order = np.argsort(ids, kind="stable")
    return Model(ids[order], slot[:len(ids)][order], own[order], slot[FREQUENT:], tokens + distinct + 1.0,
                 counts, words, weights)


def features(outcomes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The rows of the class layer that predict each of ``outcomes``, beside row 0; texts begin at ``starts``."""
    before = []
    current = outcomes
    for _ in range(3):
        current = np.concatenate([[START], current[:-1]])
        current[starts] = START
        before.append(current)
    one, two, three = before
    trigram = _hashed(one * (OUTCOMES + 1) + two, TRIGRAMS)
    step = OUTCOMES + 1
    return np.stack([1 + one, 1 + step + two, 1 + 2 * step + three, 1 + 3 * step + trigram])


def _steps(outcomes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """``STEP_TOKENS`` tokens at a time: where they are, and their features, which depend on the three before them."""
    for at in range(0, len(outcomes), STEP_TOKENS):
        part, begin = slice(at, at + STEP_TOKENS), max(at - 3, 0)
        inside = starts[np.searchsorted(starts, begin):np.searchsorted(starts, at + STEP_TOKENS)]
        yield part, features(outcomes[begin:part.stop], inside - begin)[:, at - begin:]


def member_rows(rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The rows of the second layer, beside that of the class: hashed pairs of the last two words and the class."""
    return CLASS_ROWS + CLASSES + _hashed(rows[:2] * CLASSES + classes, MEMBER_ROWS - CLASSES)


def _hashed(numbers: np.ndarray, rows: int) -> np.ndarray:
    """``rows`` is a power of two."""
    return (numbers.astype(np.uint64) * _MIX >> np.uint64(65 - rows.bit_length())).astype(np.int64)


def _exponentials(weights: np.ndarray, first: np.ndarray | int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The softmax's numerators, a row for each token, and what to multiply each row by."""
    found = np.empty((rows.shape[1], CLASSES), weights.dtype)
    for at in range(0, len(found), CACHED_TOKENS):
        sums, part = found[at:at + CACHED_TOKENS], slice(at, at + CACHED_TOKENS)
        np.take(weights, rows[0, part], axis=0, out=sums, mode="clip")
        sums += weights[first] if isinstance(first, int) else np.take(weights, first[part], axis=0, mode="clip")
        for column in rows[1:, part]:
            sums += np.take(weights, column, axis=0, mode="clip")
        np.clip(sums, -GREATEST_SUM, GREATEST_SUM, out=sums)
        np.exp(sums, out=sums)
    return found, 1 / (found @ np.ones(CLASSES, weights.dtype))


def _log_softmax_at(weights: np.ndarray, first: np.ndarray | int, rows: np.ndarray, targets: np.ndarray) -> np.ndarray:
    found, scale = _exponentials(weights, first, rows)
    return np.log(found[np.arange(len(targets)), targets]) + np.log(scale)


def log_probabilities(model: Model, outcomes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The natural logarithm of each outcome's probability after the ones before, some at a time."""
    found = np.empty(len(outcomes))
    for part, rows in _steps(outcomes, starts):
        classes, members = np.divmod(outcomes[part], MEMBERS)
        found[part] = (
            _log_softmax_at(model.weights, 0, rows, classes)
            + _log_softmax_at(model.weights, CLASS_ROWS + classes, member_rows(rows, classes), members))
    return found


def gradient(
    weights: np.ndarray, first: np.ndarray | int, rows: np.ndarray, targets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, sums, tokens): of each row that occurs, the gradient of the targets' log probability, and its tokens.

    ``first`` is one row for all, or the row of each one's class; ``rows`` may be many.
    """
    error, scale = _exponentials(weights, first, rows)
    error *= -scale[:, None]
    error[np.arange(len(targets)), targets] += 1
    found, sums, times = _summed(rows, error)
    if isinstance(first, int):
        few, of_few, tokens = np.array([first]), np.ones(len(targets), error.dtype)[None] @ error, np.array([len(targets)])
    else:
        tokens = np.bincount(first - CLASS_ROWS, minlength=CLASSES)
        few = np.flatnonzero(tokens)
        of_few = (np.eye(CLASSES, dtype=error.dtype)[first - CLASS_ROWS].T @ error)[few]
        few, tokens = few + CLASS_ROWS, tokens[few]
    return np.concatenate([few, found]), np.concatenate([of_few, sums]), np.concatenate([tokens, times])


def _summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct numbers of ``rows``, the sums of the ``values`` of each one's tokens, and how often it occurs.

    Numbers that occur seldom, by far the most, are summed side by side: first, second, third ... occurrences.
    """
    flat = rows.ravel().astype(np.uint16 if ROWS <= 1 << 16 else np.uint32)
    order = np.argsort(flat, kind="stable")
    flat, token = flat[order], order % len(values)
    begins = np.concatenate([[0], np.flatnonzero(flat[1:] != flat[:-1]) + 1])
    times = np.diff(begins, append=len(flat))
    often = np.flatnonzero(times > SELDOM)
    by_times = np.argsort(SELDOM + 1 - np.minimum(times, SELDOM + 1).astype(np.uint8), kind="stable")
    sums = np.take(values, token[begins[by_times]], axis=0)
    at = begins[by_times[len(often):]]
    for time in range(1, SELDOM):
        at = at[:np.count_nonzero(times > time) - len(often)] + 1
        sums[len(often):len(often) + len(at)] += np.take(values, token[at], axis=0)
    ones = np.ones(times.max(), values.dtype)
    for place, (begin, time) in enumerate(zip(begins[often].tolist(), times[often].tolist(), strict=True)):
        np.dot(ones[:time], np.take(values, token[begin:begin + time], axis=0), out=sums[place])
    return flat[begins[by_times]].astype(np.int64), sums, times[by_times]


class _Learner:
    """Gradient steps from the weights of a round's beginning, scaled by the gradients so far."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights = weights.copy()
        self.squares = np.full(weights.shape, 1e-2, np.float32)
        self.tokens = np.zeros(len(weights), np.int64)

    def learn(self, outcomes: np.ndarray, starts: np.ndarray) -> None:
        for part, rows in _steps(outcomes, starts):
            classes, members = np.divmod(outcomes[part], MEMBERS)
            self._step(0, rows, classes)
            self._step(CLASS_ROWS + classes, member_rows(rows, classes), members)

    def _step(self, first: np.ndarray | int, rows: np.ndarray, targets: np.ndarray) -> None:
        found, sums, tokens = gradient(self.weights, first, rows, targets)
        sums *= (1 / np.sqrt(tokens)).astype(np.float32)[:, None]
        squares = np.take(self.squares, found, axis=0, mode="clip")
        squares += sums * sums
        self.squares[found] = squares
        np.sqrt(squares, out=squares)
        sums *= np.float32(RATE)
        sums /= squares
        sums += np.take(self.weights, found, axis=0, mode="clip")
        self.weights[found] = sums
        self.tokens[found] += tokens


def _texts_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)[:-1]])


def _column(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name))[row].values.to_numpy(zero_copy_only=False)


def _learnt(batches: Iterator[pa.RecordBatch], schema: pa.Schema, model: Model, round_: int) -> Iterator[pa.RecordBatch]:
    """How the texts of a round move the weights: a row of the model, the moves times a share, and the share."""
    learner = _Learner(model.weights)
    for batch in batches:
        for row in range(batch.num_rows):
            lengths, held = _column(batch, "lengths", row), _column(batch, "held", row).astype(bool)
            taken = ~held & (np.arange(len(held)) % ROUNDS == round_)
            if not taken.any():
                continue
            tokens = _unpacked(batch.column(batch.schema.get_field_index("tokens"))[row].as_py())
            outcomes, _ = model.outcomes(_column(batch, "vocabulary", row))
            learner.learn(outcomes[tokens[np.repeat(taken, lengths)]], _texts_of(lengths[taken]))
    rows = np.flatnonzero(learner.tokens)
    if len(rows):
        # The share of a task grows with the logarithm of its tokens, so that every sum stays a small number.
        share = np.floor(np.log2(learner.tokens[rows])).astype(np.int64) + 1
        moves = np.rint((learner.weights[rows] - model.weights[rows]).astype(np.float64) * SCALE * share[:, None]).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows.astype(np.int32)), pa.array(share.astype(np.int32)), *[pa.array(moves[:, i]) for i in range(CLASSES)]], schema=schema)


def train(blocks: DataFrame, counts: DataFrame) -> Model:
    """The model of all texts of ``blocks`` that are not held out; ``counts`` (id, n) are their words'.

    Each round every task takes gradient steps through the next share of its texts; the moves of the tasks are
    averaged row by row where rows of the model meet, and the driver gets the average, ``ROWS`` rows of it.
    """
    spark = blocks.sparkSession
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("words")).first()
    frequent = [tuple(row) for row in counts.orderBy(F.col("n").desc(), "id").limit(FREQUENT).collect()]
    suffix = F.pmod("id", F.lit(SUFFIXES))
    # FREQUENT ids as literals; the groups are SUFFIXES.
    rare = counts.filter(~F.col("id").isin([pair[0] for pair in frequent])) if frequent else counts
    suffixes = [tuple(row) for row in rare.groupBy(suffix.alias("suffix")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()]
    model = new_model(frequent, suffixes, whole["n"], whole["words"])
    names = [f"m{i}" for i in range(CLASSES)]
    schema = "row int, share int, " + ", ".join(f"{name} long" for name in names)
    for round_ in range(ROUNDS):
        sent = spark.sparkContext.broadcast(model)

        def learnt(batches: Iterator[pa.RecordBatch], target: pa.Schema, sent=sent, round_=round_) -> Iterator[pa.RecordBatch]:
            return _learnt(batches, target, sent.value, round_)

        moves = _mapped(blocks.select("held", "lengths", "vocabulary", "tokens"), learnt, schema).groupBy("row").agg(
            F.sum("share").alias("share"), *[F.sum(name).alias(name) for name in names]).toArrow()
        rows = moves.column("row").to_numpy()
        sums = np.stack([moves.column(name).to_numpy() for name in names], 1) if len(rows) else np.zeros((0, CLASSES))
        weights = model.weights.copy()
        weights[rows] += (sums / moves.column("share").to_numpy()[:, None] / SCALE).astype(np.float32)
        model.weights = weights
    return model


def _scored(batches: Iterator[pa.RecordBatch], schema: pa.Schema, model: Model) -> Iterator[pa.RecordBatch]:
    ten = np.log(10)
    base_total = model.counts + model.words + 1
    for batch in batches:
        for row in range(batch.num_rows):
            lengths, vocabulary = _column(batch, "lengths", row), _column(batch, "vocabulary", row)
            counts = np.zeros(len(vocabulary))
            known = batch.column(batch.schema.get_field_index("known"))[row]
            if known.is_valid:
                counts[known.values.field("at").to_numpy()] = known.values.field("n").to_numpy()
            tokens = _unpacked(batch.column(batch.schema.get_field_index("tokens"))[row].as_py())
            outcomes, own = model.outcomes(vocabulary)
            base = np.log10((counts + 1) / base_total)
            within = model.within(vocabulary, counts, own) / ten
            starts = _texts_of(lengths)
            score = log_probabilities(model, outcomes[tokens], starts) / ten + within[tokens]
            each = [np.add.reduceat(values, starts) for values in ((counts > 0)[tokens].astype(np.int64), base[tokens], score)]
            ids, held = (batch.column(batch.schema.get_field_index(name))[row].values for name in ("ids", "held"))
            columns = [ids, held, lengths.astype(np.int64), each[0], np.full(len(lengths), model.counts), each[1], each[2]]
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, field.type) for x, field in zip(columns, schema, strict=True)], schema=schema)


def score_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", share: int = 7, held: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    Rows whose crc32 of the id as text leaves ``held`` modulo ``share`` are held out: scored, but not learnt from. A null id
    counts as an empty text, a null text as an empty one, which has one token, its end. ``score`` and ``base_score`` are
    base-10 logarithms of the text's probability by the model and by smoothed counts. Equal rows are learnt from as often as they
    are there; texts are read whole, however long; other columns are not read. Without rows to learn from all
    outcomes are equally likely; no rows: no rows.

    Words are told apart by 64 bits of a hash. Reruns over the same files agree.
    """
    name = F.col(f"`{doc_id}`")
    is_held = F.crc32(F.coalesce(name.cast("string"), F.lit("")).cast("binary")) % share == held
    blocks = token_blocks(docs.select(name.alias("id"), is_held.alias("held"), F.col(f"`{text}`").alias("text")))
    counts = written(
        blocks.select(F.explode(F.arrays_zip("vocabulary", "learnt")).alias("word"))
        .select(F.col("word.vocabulary").alias("id"), F.col("word.learnt").alias("n")).filter("n > 0")
        .groupBy("id").agg(F.sum("n").alias("n")))
    model = train(blocks, counts)
    # A word is asked for once by each block that has it, so no word is asked for more often than there are blocks.
    asked = blocks.select("block", F.posexplode("vocabulary").alias("at", "id"))
    known = asked.join(counts.hint("merge"), "id").groupBy("block").agg(F.collect_list(F.struct("at", "n")).alias("known"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()
    return _mapped(
        blocks.select("block", "ids", "held", "lengths", "vocabulary", "tokens").join(known.hint("merge"), "block", "left"),
        lambda batches, schema: _scored(batches, schema, sent.value),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
