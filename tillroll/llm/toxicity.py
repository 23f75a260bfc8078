"""Operator 6: toxicity by compression distance to two trained zstandard dictionaries."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.tables import map_batches, table

SAMPLE_ROWS = 4_000          # labelled texts of each kind for the dictionaries, at most
CALIBRATION_ROWS = 8_000     # other labelled texts for the thresholds, at most
SAMPLE_CHARS = 8_000         # characters of a text that the dictionaries learn from, at a place that its hash chooses
DICTIONARY_BYTES = (16_384, 8_192)  # first round, second round
CLEAR = 3                    # bytes that mark a window as one kind's in the second round
THRESHOLDS = (1, 2, 3, 4, 5)
FEATURES = 4 + 2 * len(THRESHOLDS)

_PAD = b"\n" * 24            # zstandard finds no match in a block's last bytes, so they are not the word's
_CACHED = 1 << 17


@dataclass(frozen=True)
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one is the constant


def windows(text: str | None) -> list[bytes]:
    """The windows of a whole text: its lower-case words, parted by ASCII white space.

    Windows of several words were measured and find fewer of the toxic texts, as README says.
    """
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


class Distance(dict):
    """How many bytes more a window takes with the ordinary dictionary than with the toxic one."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        super().__init__()
        self._with = [_compressor(content) for content in (ordinary, toxic)]

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED:
            self.clear()
        window = b" " + word + b" " + _PAD
        ordinary, toxic = (len(compressor.compress(window)) for compressor in self._with)
        self[word] = ordinary - toxic
        return ordinary - toxic


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    # Raw content: what a dictionary holds is matched, and windows that it does not hold cost the same with both.
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=zstandard.ZstdCompressionParameters(
        window_log=18, chain_log=16, hash_log=15, search_log=6, min_match=4, target_length=64,
        strategy=zstandard.STRATEGY_LAZY, write_content_size=False, write_checksum=False, write_dict_id=False))


def features(distance: Distance, text: str | None) -> list[float]:
    """Largest and mean distance of the windows, and how many reach each threshold; zeros for no windows."""
    found = np.fromiter(map(distance.__getitem__, windows(text)), np.int64)
    if not len(found):
        return [0.0] * FEATURES
    reached = [int((found >= threshold).sum()) for threshold in THRESHOLDS]
    top = np.partition(found, -3)[-3:] if len(found) > 3 else found
    return [float(found.max()), float(top.mean()), float(found.mean()), float(np.log1p(len(found))),
            *[n / len(found) for n in reached], *[float(np.log1p(n)) for n in reached]]


def _trained(texts: list[list[bytes]], size: int) -> bytes:
    """A dictionary of up to ``size`` bytes for lists of windows, by zstandard's own training."""
    samples = []
    for words in texts:
        chunk, length = [], 0
        for word in words:
            chunk.append(word)
            length += len(word) + 1
            if length >= 48:
                samples.append(b" " + b" ".join(chunk) + b" ")
                chunk, length = [], 0
        if chunk:
            samples.append(b" " + b" ".join(chunk) + b" ")
    try:
        return _content(zstandard.train_dictionary(size, samples, k=16, d=6).as_bytes())
    except zstandard.ZstdError:  # too few samples to choose from: they are the dictionary
        return b"".join(samples)[:size] or b" "


def _content(dictionary: bytes) -> bytes:
    """What a trained dictionary holds of the samples: all behind its tables, which end in the three first offsets."""
    offsets = b"".join(offset.to_bytes(4, "little") for offset in (1, 4, 8))
    return dictionary[dictionary.index(offsets) + len(offsets):]


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """A dictionary of toxic and one of ordinary texts.

    The first ones learn from all windows. The second ones learn only from windows that the first take
    for toxic, in toxic texts and in ordinary ones, so that chance findings are in both and cancel out.
    """
    kinds = [[[word for word in dict.fromkeys(windows(text)) if len(word) >= 3] for text in texts]
             for texts in (toxic, ordinary)]
    first = Distance(*[_trained(kind, DICTIONARY_BYTES[0]) for kind in kinds])
    hard = [[[word for word in words if first[word] >= CLEAR] for words in kind] for kind in kinds]
    own, other = (_trained(kind, DICTIONARY_BYTES[1]) for kind in hard)
    return own, other


def calibrate(toxic: bytes, ordinary: bytes, x: np.ndarray, y: np.ndarray) -> ToxicityModel:
    """The model of two dictionaries, with weights by a regression of the labels ``y`` on the features ``x``."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    return ToxicityModel(toxic, ordinary, mean, scale, _logistic((x - mean) / scale, y))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, steps: int = 40) -> np.ndarray:
    """Weights of a logistic regression by damped Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + penalty * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(weights))
        weights -= np.clip(np.linalg.solve(bend, slope), -2, 2)
    return weights


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks.

    Labelled rows are halved by a hash of the id: one half trains the dictionaries, the other the weights.
    Of rows with equal doc_id one text is learnt from. The driver gets at most ``2 * SAMPLE_ROWS`` parts of texts of
    ``SAMPLE_CHARS`` characters and the features of ``CALIBRATION_ROWS`` whole texts, which tasks work out. Null texts are
    empty ones. Without labelled rows all scores are alike.
    """
    marked = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ranked = marked.withColumn("order", F.xxhash64("doc_id")).withColumn("half", F.pmod("order", F.lit(2)))
    part = lambda keep, rows: ranked.filter(keep).orderBy("order", "doc_id").limit(rows)

    def one_text(chosen: DataFrame, text: Column) -> DataFrame:
        rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
        return rows.groupBy("order", "doc_id", "toxic").agg(
            F.min(F.struct(F.xxhash64("text").alias("hash"), text.alias("text"))).alias("first")).select(
            "order", "doc_id", "toxic", "first.text")

    spare = F.greatest(F.length("text") - F.lit(SAMPLE_CHARS - 1), F.lit(1))
    span = F.substring(F.col("text"), F.pmod(F.xxhash64("text"), spare).cast("int") + 1, F.lit(SAMPLE_CHARS))
    sample = one_text(part("half = 0 and toxic = 1", SAMPLE_ROWS).unionByName(
        part("half = 0 and toxic = 0", SAMPLE_ROWS)), span).toPandas().sort_values(["order", "doc_id", "text"])
    own, other = dictionaries(*[sample[sample.toxic == kind].text.tolist() for kind in (1, 0)])

    def measured(batch: dict[str, list]) -> dict[str, list]:
        distance = _distance(own, other)
        return {"order": batch["order"], "y": batch["y"], "x": [features(distance, text) for text in batch["text"]]}

    found = map_batches(
        one_text(part("half = 1", CALIBRATION_ROWS), F.col("text")).select("order", F.col("toxic").cast("double").alias("y"), "text"),
        measured, "order long, y double, x array<double>").toPandas().sort_values("order", kind="stable")
    if not len(found):
        return calibrate(own, other, np.zeros((1, FEATURES)), np.zeros(1))
    return calibrate(own, other, np.array(found.x.tolist()), found.y.to_numpy())


def score_texts(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` without its text, plus ``score`` (0 to 1) and ``predicted``; whole texts, no shuffle.

    A null text scores as an empty one. Equal texts score alike. Columns called like the two results are replaced. No rows: no rows.
    """
    kept = [field for field in docs.schema.fields if field.name not in ("text", "score", "predicted")]

    def scored(batch: dict[str, list]) -> dict[str, list]:
        distance = _distance(model.toxic, model.ordinary)
        x = np.array([features(distance, text) for text in batch["text"]]).reshape(-1, FEATURES)
        x = np.column_stack([(x - model.mean) / model.scale, np.ones(len(x))])
        score = 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))
        return {**batch, "score": score.tolist(), "predicted": (score >= 0.5).astype(int).tolist()}

    schema = "".join(f"`{field.name}` {field.dataType.simpleString()}, " for field in kept)
    return map_batches(docs, scored, f"{schema}score double, predicted int")


_distances: dict[tuple[bytes, bytes], Distance] = {}


def _distance(toxic: bytes, ordinary: bytes) -> Distance:
    """One cache per Python worker and model."""
    if (toxic, ordinary) not in _distances:
        _distances.clear()
        _distances[toxic, ordinary] = Distance(toxic, ordinary)
    return _distances[toxic, ordinary]


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learnt from: those whose crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return score_texts(rows, model)
