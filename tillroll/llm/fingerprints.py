"""Operator 4: document fingerprints by order min-hash, which sense edits and reordering."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.tables import share_code, table

K = 16          # code points of a k-mer
SKETCHES = 64   # positions of a fingerprint
TUPLE = 2       # k-mers of a sketch, in text order
DIGITS = 4      # hex digits of a position
ROWS_PER_RANGE = 100_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
_ARC_BITS = np.uint64(64 - SKETCHES.bit_length() + 1)  # each sketch starts one arc of the ring after the last
_STARTS = np.arange(SKETCHES, dtype=np.uint64) << _ARC_BITS
_PER_ARC = 16  # k-mers kept per arc at first; where one has too few, all are sorted


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (the public splitmix64 finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def kmer_hashes(codes: np.ndarray) -> np.ndarray:
    """One hash per window of ``K`` code points, put together from windows of half the length; a shorter text
    is one window."""
    windows = codes.astype(np.uint64) + _GOLDEN
    if len(codes) < K:
        powers = np.cumprod(np.full(len(codes), _MULTIPLIERS[0]))
        return mixed(np.array([(windows * powers).sum() + np.uint64(len(codes))], np.uint64))
    for level, multiplier in enumerate(_MULTIPLIERS):
        half = 1 << level
        windows = windows[:-half] * multiplier + windows[half:]
    return mixed(windows)


def fingerprint(text: str) -> str:
    """``SKETCHES`` hex numbers of ``DIGITS`` digits.

    K-mers are numbered by occurrence, so repeats count. Their hashes lie on a ring; each sketch orders them
    from a starting point of its own, selects the ``TUPLE`` first ones, puts these back in text order and hashes
    the tuple. A text shorter than ``K`` is one k-mer; an empty one has none, and a value of its own.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return "0" * (SKETCHES * DIGITS)
    ring, position = _ring(kmer_hashes(codes))
    chosen = np.searchsorted(ring, _STARTS)[:, None] + np.arange(min(TUPLE, len(ring)))
    chosen %= len(ring)
    in_text = np.take_along_axis(chosen, np.argsort(position[chosen], axis=1), axis=1)
    value = np.zeros(SKETCHES, np.uint64)
    for column in ring[in_text].T:
        value = mixed(value * np.uint64(5) + column)
    return (value >> np.uint64(64 - 4 * DIGITS)).astype(">u2").tobytes().hex()


def _ring(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the occurrence-numbered k-mers in order, and their places in the text.

    Only those near the start of an arc can be selected; the others are left out where that is enough.
    """
    in_order = np.sort(hashes)
    if (in_order[1:] == in_order[:-1]).any():
        position = np.argsort(hashes, kind="stable")
        ring = hashes[position]
        starts = np.flatnonzero(np.concatenate([[True], ring[1:] != ring[:-1]]))
        occurrence = np.arange(len(ring)) - np.repeat(starts, np.diff(np.append(starts, len(ring))))
        repeated = occurrence > 0
        ring[repeated] = mixed(ring[repeated] + occurrence[repeated].astype(np.uint64) * _GOLDEN)
        again = np.argsort(ring, kind="stable")
        return ring[again], position[again]
    position = np.arange(len(hashes))
    if len(hashes) > 2 * SKETCHES * _PER_ARC:
        arc = 1 << int(_ARC_BITS)
        near = np.flatnonzero((hashes & np.uint64(arc - 1)) < np.uint64(arc // len(hashes) * SKETCHES * _PER_ARC))
        if np.bincount((hashes[near] >> _ARC_BITS).astype(np.int64), minlength=SKETCHES).min() >= TUPLE:
            position = near
    order = np.argsort(hashes[position])
    return hashes[position][order], position[order]


def likeness(one: str, other: str) -> float:
    """The share of equal positions."""
    if one == other:
        return 1.0
    a, b = (np.frombuffer(bytes.fromhex(text), ">u2") for text in (one, other))
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the next text."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


OUTPUT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text), and how near each is to its edited text and to the next document.

    Documents follow each other by descending doc_id, nulls last, equal ids by a hash of the text; the first one
    follows the last. Null texts are empty. No rows: no rows.

    Ids are cut into ranges of about equal size, a task reads the texts of one range in order, and the first
    document of each range also goes to the range before it. So every text is shuffled once. The driver holds
    one bound per range. Null ids, and rows of one id, are in one range.
    """
    spark = docs.sparkSession
    share_code(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.select("doc_id")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-ids.count() // ROWS_PER_RANGE))
    shares = [(i + 1) / ranges for i in range(ranges)]
    # Each bound is an id of the table, the largest of its range: the range's first one in descending order.
    bounds = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 4 * ranges)).first()[0] or []))
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("tie"),
        _range_of(bounds)(F.col("doc_id")).alias("found"))
    own = F.struct(F.col("found.range"), F.lit(0).alias("guest"))
    before = F.pmod(F.col("found.range") + 1, F.lit(max(len(bounds), 1)))
    guest = F.struct(before.alias("range"), F.lit(1).alias("guest"))
    places = F.when(F.col("found.is_first"), F.array(own, guest)).otherwise(F.array(own))
    ordered = (
        rows.withColumn("place", F.explode(places))
        .select("place.range", "place.guest", "doc_id", "tie", "text")
        .repartitionById(max(len(bounds), 1), F.col("range"))
        .sortWithinPartitions("range", "guest", F.col("doc_id").desc_nulls_last(), "tie")
        .select("range", "guest", "doc_id", "text"))
    return ordered.mapInArrow(_walk, f"doc_id {kind}, {OUTPUT}")


def _range_of(bounds: list):
    cuts = np.array(bounds or [0])

    @F.pandas_udf("range int, is_first boolean")
    def found(ids: pd.Series) -> pd.DataFrame:
        null = ids.isna().to_numpy()
        values = ids.fillna(cuts[0]).to_numpy(cuts.dtype)
        where = np.searchsorted(cuts, values)
        first = (values == cuts[where]) & ~null if bounds else np.ones(len(ids), bool)
        return pd.DataFrame({"range": where.astype(np.int32), "is_first": first})

    return found


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and order: each own row is finished when the next row of its range is seen."""
    waiting, out = None, []  # waiting: range, id, text and fingerprint
    schema = None
    for batch in batches:
        schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("n_chars", pa.int64()),
                            *[(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                            ("near_edited", pa.float64()), ("near_next", pa.float64())])
        for range_, guest, doc_id, text in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            own = fingerprint(text)
            if waiting is not None and waiting[0] == range_:
                out.append(_finished(*waiting[1:], text, own))
                waiting = None
            if not guest:
                waiting = (range_, doc_id, text, own)
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), schema.types, strict=True)],
                schema=schema)
            out = []


def _finished(doc_id, text: str, own: str, following: str, next_fingerprint: str) -> tuple:
    changed = edited(text, following)
    changed_fingerprint = own if changed == text else fingerprint(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own,
            changed_fingerprint, likeness(own, changed_fingerprint), likeness(own, next_fingerprint))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))
