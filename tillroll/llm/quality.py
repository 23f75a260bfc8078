"""Operator 5: quality rules by compression bands, after base counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.tables import map_batches, table

# Fixed values of the query's base rules.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
LEAST_WORDS = 50
REPEATED_PERCENT = 50

LEVEL = 3
CHUNK = 4096  # bytes of a chunk; a last one of less than half belongs to the one before
BAD_CHUNKS = 0.3  # share of chunks beyond their limits that rejects a text

LEAST_SAMPLE = 30     # fewer good documents of a length borrow from longer texts, cut to it, or from shorter ones
TAIL, MARGIN = 0.001, 0.01
CHAINS, PART, LINKED = 16, 8192, 1 << 20  # long texts are stood for by chains of all good ones, this many at least, of about so many bytes; the parts that alternate there
DEFAULT_LIMITS = (0.12, 1.10)  # of lengths below SHORTEST, which have too few words, and without good documents
SHORTEST, LONGEST = 12, 62     # half octaves that get limits: from 64 bytes to more than a text can hold

Limits = dict[int, tuple[float, float]]  # half octave of the length in bytes -> least and greatest ratio


def length_band(size: int) -> int:
    return int(2 * math.log2(max(size, 1)))


def fit_limits(docs: DataFrame, good: DataFrame) -> Limits:
    """Limits for each length from all documents of ``docs`` that ``good`` (doc_id) lists.

    They leave out ``TAIL`` of these documents at either end, less ``MARGIN``. A length of fewer than ``LEAST_SAMPLE``
    documents takes in the beginnings of all longer ones, cut to the least and the greatest size of that length. If these
    are too few as well, the text is longer than nearly all good ones: the greatest ratio is then that of the next shorter
    length that has one, as ratios fall with the length, and so is the least one, less as much as ratios fall from that
    length to this one in good texts put end to end (beyond the longest chain of them ratios are taken to stay). Only fewer
    than ``LEAST_SAMPLE`` good documents give no limits.

    Ratios are measured where the texts are, and joined with ``good`` without them. A task holds the different ratios
    of a length.
    """
    kind = docs.schema["doc_id"].dataType
    wanted = good.select(F.col("doc_id").cast(kind).alias("doc_id")).filter("doc_id is not null").distinct()
    sizes = ratio_ends(docs, wanted)
    limits, total = {}, sum(row["size"] for row in sizes)
    longest = max((row["band"] for row in sizes), default=0)
    found = {row["band"]: row for row in sizes if row["n"] >= LEAST_SAMPLE}
    few = [band for band in range(SHORTEST, longest) if band not in found]
    if few:
        found |= {row["band"]: row for row in ratio_ends(docs, wanted, few) if row["n"] >= LEAST_SAMPLE}
    for band, row in found.items():
        limits[band] = (row["least"] - MARGIN, row["most"] + MARGIN)
    fall = chain_ratios(docs, wanted, max(CHAINS, total // LINKED)) if limits else {}
    for band in range(SHORTEST, LONGEST):
        if band not in limits and band - 1 in limits:
            before, after = fall.get(band - 1), fall.get(band)
            share = min(1.0, after / before) if before and after else 1.0
            limits[band] = (limits[band - 1][0] * share, limits[band - 1][1])
    return limits


def ratio_ends(docs: DataFrame, wanted: DataFrame, cut_to: Sequence[int] = ()) -> list[Row]:
    """``n`` texts, their bytes ``size`` and the ``least`` and ``most`` ratio but for ``TAIL`` for each length of the
    documents that ``wanted`` (doc_id) lists; with ``cut_to`` for these lengths, longer texts cut to them among theirs."""
    names = ("doc_id", "band", "size", "low", "high")

    def measured(batch: dict[str, list]) -> dict[str, list]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            own = length_band(len(data))
            if data and (not cut_to or own in cut_to):
                rows.append((doc_id, own, len(data), *[ratio(compressor, data)] * 2))
            for band in cut_to:
                if band < own:
                    cut = [ratio(compressor, data[:size]) for size in band_sizes(band)]
                    rows.append((doc_id, band, len(data), min(cut), max(cut)))
        return dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)) if rows else {name: [] for name in names}

    kind = docs.schema["doc_id"].dataType.simpleString()
    ratios = map_batches(docs.select("doc_id", "text"), measured, f"doc_id {kind}, band int, size long, low double, high double")
    counted = ratios.join(wanted.hint("merge"), "doc_id", "left_semi").groupBy("band", "low", "high").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    return counted.groupBy("band").agg(
        F.sum("n").alias("n"), F.sum("size").alias("size"), F.percentile("low", TAIL, F.col("n")).alias("least"),
        F.percentile("high", 1 - TAIL, F.col("n")).alias("most")).collect()


def chain_ratios(docs: DataFrame, wanted: DataFrame, chains: int) -> dict[int, float]:
    """The mean ratio of the texts that ``wanted`` (doc_id) lists, put end to end, cut to the least size of each length.

    Every text goes whole to one of ``chains`` chains by a hash of the id. A chain has the first ``PART`` characters of each
    of its texts in the order of that hash, then the next ones and so on, so chains do not depend on how rows are
    partitioned. A task holds the texts of a chain, of which there are as many as the texts need.
    """
    def linked(rows: pd.DataFrame, listed: pd.DataFrame) -> pd.DataFrame:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        rows = rows[rows.doc_id.isin(listed.doc_id)]
        parts = sorted((at, order, text[at:at + PART]) for order, text in zip(rows.order, rows.text, strict=True)
                       for at in range(0, len(text), PART))
        data = " ".join(part for _, _, part in parts).encode("utf-8", "surrogatepass")
        found = []
        for band in range(SHORTEST, length_band(len(data)) + 1):
            size = band_sizes(band)[0]
            if size <= len(data):
                found.append((band, ratio(compressor, data[:size])))
        return pd.DataFrame(found, columns=["band", "ratio"])

    order = F.xxhash64("doc_id")
    texts = docs.select("doc_id", "text", order.alias("order")).filter("doc_id is not null and text <> ''")
    one, other = (side.withColumn("chain", F.pmod(order, F.lit(chains))).groupBy("chain") for side in (texts, wanted))
    means = one.cogroup(other).applyInPandas(linked, "band int, ratio double").groupBy("band").agg(F.avg("ratio").alias("mean"))
    return {row["band"]: row["mean"] for row in means.collect()}


def band_sizes(band: int) -> tuple[int, int]:
    """The least and the greatest length of a half octave."""
    least, following = (math.ceil(2 ** (at / 2)) for at in (band, band + 1))
    return least, following - 1


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text; a null text has none."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    word_chars = len(text or "") - (len(data) - len(data.translate(None, SPACES)))
    n_symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.translate(None, SPACES)]
    return len(words), word_chars, n_symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """How many words stand in windows of three words that the text has twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(word, len(number)) for word in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, window, counts = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[window] > 1)
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[starts + shift] = True
    return int(covered.sum())


def ratio(compressor: zstandard.ZstdCompressor, data: bytes) -> float:
    return len(compressor.compress(data)) / len(data)


def within(value: float, size: int, limits: Limits) -> bool:
    least, most = limits.get(length_band(size), DEFAULT_LIMITS)
    return least <= value <= most


def compression_verdict(
    compressor: zstandard.ZstdCompressor, data: bytes, limits: Limits
) -> tuple[float, float, bool]:
    """The whole text's ratio, the share of its chunks beyond their limits, and whether both are good."""
    if not data:
        return 0.0, 0.0, False
    whole = ratio(compressor, data)
    good = within(whole, len(data), limits)
    edges = [*range(0, max(len(data) - CHUNK // 2, 1), CHUNK), len(data)]
    chunks = [data[start:end] for start, end in zip(edges, edges[1:], strict=False)]
    if len(chunks) == 1:
        return whole, float(not good), good
    bad = sum(not within(ratio(compressor, chunk), len(chunk), limits) for chunk in chunks) / len(chunks)
    return whole, bad, good and bad <= BAD_CHUNKS


def quality_rules(docs: DataFrame, limits: Limits) -> DataFrame:
    """Counts and verdicts for each row of ``docs`` (doc_id, text); whole texts, no shuffle.

    ``limits`` come from ``fit_limits``. A null or empty text fails the base rules (no words). Rows are judged one by one, so repeats agree.
    """
    def judged(batch: dict[str, list]) -> dict[str, list]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 "base_failed", "kept", "whole_ratio", "bad_chunks")
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            counts = base_counts(text)
            failed = counts[0] < LEAST_WORDS or 100 * counts[4] > REPEATED_PERCENT * counts[0]
            whole, bad, good = compression_verdict(
                compressor, (text or "").encode("utf-8", "surrogatepass"), limits)
            rows.append((doc_id, *counts, failed, good and not failed, whole, bad))
        return dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)) if rows else {n: [] for n in names}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), judged, (
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, whole_ratio double, bad_chunks double"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").filter("quality = 1")
    return quality_rules(docs, fit_limits(docs, good))
