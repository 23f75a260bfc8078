"""Operator 3: pack documents into token sequences by matching large items and best fit for the small."""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from pathlib import Path

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.ranks import hashed_key, hex_digits, place, running_sum
from tillroll.llm.tables import map_batches, table
from tillroll.scratch import materialise

CAPACITY = 2048
SEPARATOR = 0
CACHED_PIECES = 1 << 17  # of each of two generations

# A space is no safe place to cut where it stands in a run of white space that goes on after it.
_UNSAFE = re.compile(r"\s (?:\s|\Z)|^ (?:\s|\Z)")
# What the two libraries may see differently, or the faster one may refuse: other scripts, other control characters and
# white space, runs of white space, and names of special tokens.
_UNCOMMON = re.compile("[^\n !-~\u00a1-\u052f]")
_LONG_RUN = re.compile("[\n ]{64}")
_tokenizers: dict[tuple[str, str], TokenIds] = {}


class TokenIds(dict):
    """The ids of texts as little-endian unsigned 32-bit numbers.

    ``ranks`` is the same vocabulary in the form of a faster library, which encodes texts of Latin, Greek and Cyrillic
    letters as a whole, and such words of other texts, where the two cannot differ. In those others, the tokenizer's
    pattern starts a new piece at each single space, and pieces are encoded one by one. So a text is cut there, and the
    ids of what lies between are kept for the next time.
    """

    def __init__(self, path: str, ranks: str):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self._older: dict[str, bytes] = {}
        self._tokenizer = Tokenizer.from_file(path)
        with open(ranks, "rb") as lines:
            by_bytes = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding(
            Path(ranks).stem, pat_str=public_tokenizers.PATTERN, mergeable_ranks=by_bytes, special_tokens={}
        ).encode_ordinary

    def _encode(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            fast = word and max(word) < "\u0530" and " " < min(word)
            ids = array("I", self._fast(" " + word)).tobytes() if fast else self._encode(" " + word)
        if len(self) >= CACHED_PIECES:
            self._older = dict(self)
            self.clear()
        if len(word) < 64:
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        if not (_UNCOMMON.search(text) or _LONG_RUN.search(text) or "<|" in text):
            return array("I", self._fast(text)).tobytes()
        if _UNSAFE.search(text) or "<|" in text:
            return self._encode(text)
        first, *others = text.split(" ")
        return (self._encode(first) if first else b"") + b"".join(map(self.__getitem__, others))


def token_ids(path: str, ranks: str) -> TokenIds:
    """One cache per Python worker."""
    if (path, ranks) not in _tokenizers:
        _tokenizers[path, ranks] = TokenIds(path, ranks)
    return _tokenizers[path, ranks]


def token_pieces(docs: DataFrame, tokenizer: str, ranks: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text's ids and the separator, cut where longer than ``capacity``.

    The first piece of a long document is what its full pieces leave. A null text is an empty one: the separator alone.
    """
    def cut(batch: dict[str, list]) -> dict[str, list]:
        encoder, found = token_ids(tokenizer, ranks), {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            ids = encoder.of(text or "") + SEPARATOR.to_bytes(4, "little")
            total = len(ids) // 4
            edges = [0, *range(total % capacity or capacity, total + 1, capacity)] if total > capacity else [0, total]
            for piece, (start, end) in enumerate(zip(edges, edges[1:], strict=False)):
                for name, value in zip(found, (
                        doc_id, piece, start, end - start, zlib.crc32(ids[4 * start:4 * end])), strict=True):
                    found[name].append(value)
        return found

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), cut,
                       f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def match_and_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (size, first rank, first bin, items per bin, offset) that pack ``counts`` items of each size.

    Large items, above a third of ``capacity``, fit at most two to a bin: the largest one left takes the largest
    partner that fits. Then smaller items, largest first, enter the tightest gap. Bins with equal gaps are
    handled together, so the work and the number of runs depend on the number of sizes only.
    """
    runs, placed, bins = [], defaultdict(int), 0
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first bin, bins)
    open_gaps: list[int] = []

    def put(size: int, items: int, first_bin: int, per_bin: int, gap: int) -> None:
        runs.append((size, placed[size], first_bin, per_bin, capacity - gap))
        placed[size] += items

    def leave(gap: int, first_bin: int, number: int) -> None:
        if gap and number:
            if not gaps[gap]:
                insort(open_gaps, gap)
            gaps[gap].append((first_bin, number))

    left = {size: n for size, n in counts.items() if 3 * size > capacity and n}
    waiting = sorted(left)
    while waiting:
        large = waiting[-1]
        number = left[large]
        at = bisect_left(waiting, capacity - large + 1) - 1
        while number and at >= 0:
            partner = waiting[at]
            pairs = number // 2 if partner == large else min(number, left[partner])
            if not pairs:
                if partner == large:
                    at -= 1
                    continue
                break
            put(large, pairs, bins, 1, capacity)
            put(partner, pairs, bins, 1, capacity - large)
            leave(capacity - large - partner, bins, pairs)
            bins += pairs
            number -= 2 * pairs if partner == large else pairs
            if partner != large:
                left[partner] -= pairs
                if not left[partner]:
                    waiting.pop(at)
                at -= 1 if number else 0
        if number:
            put(large, number, bins, 1, capacity)
            leave(capacity - large, bins, number)
            bins += number
        waiting.remove(large)

    for size in sorted((s for s in counts if 3 * s <= capacity), reverse=True):
        number = counts[size]
        while number:
            at = bisect_left(open_gaps, size)
            if at == len(open_gaps):
                per_bin = capacity // size
                needed = -(-number // per_bin)
                leave(capacity, bins, needed)
                bins += needed
                continue
            gap = open_gaps[at]
            first_bin, available = gaps[gap].pop()
            if not gaps[gap]:
                open_gaps.pop(at)
            per_bin = gap // size
            full = min(available, number // per_bin)
            if full:
                put(size, full * per_bin, first_bin, per_bin, gap)
                leave(gap - per_bin * size, first_bin, full)
                number -= full * per_bin
            rest, available = first_bin + full, available - full
            if available and 0 < number < per_bin:
                put(size, number, rest, number, gap)
                leave(gap - number * size, rest, 1)
                rest, available, number = rest + 1, available - 1, 0
            leave(gap, rest, available)
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (doc_id, piece, length, …), a written table.

    The driver sees the number of pieces of each length: at most ``capacity`` rows. Offsets are gapless from 0.
    Equal pieces are exchangeable. No rows: no rows.
    """
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    if not counts:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    plan = pd.DataFrame(match_and_fit(counts, capacity), columns=["size", "first", "bin", "per_bin", "offset"])
    keyed = pieces.withColumn("__key", hashed_key(*[F.col(name) for name in pieces.columns]))
    ranked = running_sum(keyed, ["length"], "__key", hex_digits(sum(counts.values())), name="__rank")
    spot = place("length", "__rank", plan)
    return ranked.withColumn("__spot", spot).select(
        *pieces.columns, F.col("__spot.bin").alias("sequence_id"), F.col("__spot.offset").alias("offset"))


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, ranks: str | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) and their places in sequences of ``capacity`` tokens.

    ``tokenizer`` and ``ranks`` are the paths of one vocabulary in its two forms.
    """
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return pack(materialise(token_pieces(docs, tokenizer, ranks, capacity)), capacity)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
